"""URL filters by Bloom filter cascades over the corpus's own keys.

A cascade's first level encodes the listed keys, each next one the keys of the
complete universe that the level before wrongly holds, in turn unlisted and
listed, until none is left. A key's first level that lacks it then decides, and
the answer is exact for every key of the universe, without a join.

Two cascades are built: rule keys (a host suffix, a space, a path prefix) over
all such keys of the corpus, and listed hosts over all hosts. Only
path prefixes of the rules' lengths are keys, so a page has few of them. The
filters reach the rows as scalar subqueries; a level takes about 1.5 bytes
per encoded key, and MAX_WORDS bounds it: rule and host lists are inputs of
bounded size, and a longer list raises an error rather than being cut.

Where no rule fits, a listed host (see ``mirror_hosts``) is blocked.

Cases: a null url, or one without ``://``, has an empty host and path, fits no
rule and is allowed; repeated rows are judged each; an empty table gives no
rows; no listed key makes an empty cascade; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.session import materialize

#: (host, path, verdict); a rule fits its host and all subdomains.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Bits per encoded key, hashes, and 64-bit words a level may take (32 MB).
BITS_PER_KEY, HASHES, MAX_WORDS = 12, 4, 4_000_000


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _bits(key: Column, level: int, words: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * HASHES + i)), F.lit(words * 64)) for i in range(HASHES)]


def _holds(words: Column, n: int, key: Column, level: int) -> Column:
    found = F.lit(True)
    for bit in _bits(key, level, n):
        word = F.get(words, F.floor(bit / 64).cast("int"))
        found = found & (F.getbit(word, (bit % 64).cast("int")) == 1)
    return found


class Cascade:
    """Exact membership of the universe's keys in a list."""

    def __init__(self, universe: DataFrame, listed: str = "listed") -> None:
        """``universe``: distinct ``key`` and the boolean column ``listed``."""
        self.levels: list[tuple[DataFrame, int]] = []
        inside = F.col(listed)
        rest = universe
        while True:
            level = len(self.levels)
            wanted = rest.where(inside if level % 2 == 0 else ~inside)
            n = wanted.count()
            if not n:
                break
            words = max(1, -(-n * BITS_PER_KEY // 64))
            if words > MAX_WORDS:
                raise ValueError(f"{n} keys need more than the bound of {MAX_WORDS} words")
            bit = wanted.select(F.explode(F.array(*_bits(F.col("key"), level, words))).alias("bit"))
            held = bit.groupBy(F.floor(F.col("bit") / 64).cast("int").alias("w")).agg(
                F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("v"))
            full = held.unionByName(rest.sparkSession.range(words).select(
                F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("v")))
            full = full.groupBy("w").agg(F.bit_or("v").alias("v"))
            row = materialize(full.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))),
                                                   lambda s: s["v"]).alias("words")), "bloom-level")
            self.levels.append((row, words))
            # of the other side, what this level wrongly holds goes on; of its own, all
            other = ~inside if level % 2 == 0 else inside
            rest = rest.where(~other | _holds(row.scalar(), words, F.col("key"), level))

    def attach(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the levels' words as columns (a subquery can't stand in a
        lambda itself)."""
        return df.withColumns({f"{name}{k}": row.scalar() for k, (row, _) in enumerate(self.levels)})

    def contains(self, key: Column, name: str) -> Column:
        """Whether a key of the universe is listed; ``name`` as for ``attach``."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in range(len(self.levels) - 1, -1, -1):
            words = self.levels[level][1]
            out = F.when(~_holds(F.col(f"{name}{level}"), words, key, level), F.lit(level % 2 == 1)).otherwise(out)
        return out


def _suffixes(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rule_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """All (suffix, prefix) keys of a url, longest first: by host, then by path."""
    cut = [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(lengths, reverse=True)]
    prefixes = F.array_compact(F.array(*cut))
    return F.flatten(F.transform(_suffixes(host), lambda h: F.transform(prefixes, lambda p: F.concat(h, F.lit(" "), p))))


def mirror_hosts(parts: DataFrame) -> DataFrame:
    """Hosts (as ``key``) all of whose pages also occur, html equal, at another
    host: content mirrors."""
    by = parts.groupBy("digest").agg((F.min("host") != F.max("host")).alias("twice"))
    pairs = parts.select("host", "digest").distinct().join(by, "digest")
    return pairs.groupBy(F.col("host").alias("key")).agg(F.min("twice").alias("listed"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict."""
    rules = RULES if rules is None else rules
    parts = materialize(pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                                     F.md5(F.encode(F.coalesce("html", F.lit("")), "utf-8")).alias("digest")), "url-parts")
    lengths = sorted({len(p) for _, p, _ in rules})
    keys = rule_keys(F.col("host"), F.col("path"), lengths)
    own = {f"{h} {p}": (f"{h}{p}", v) for h, p, v in rules}
    listed = F.col("key").isin(*own) if own else F.lit(False)
    universe = parts.where(F.col("host") != "").select(F.explode(keys).alias("key")).distinct()
    by_rule = Cascade(materialize(universe.withColumn("listed", listed), "url-keys"))
    by_host = Cascade(materialize(mirror_hosts(parts).where(F.col("key") != ""), "url-hosts"))
    fits = F.when(F.col("host") != "", F.filter(keys, lambda k: by_rule.contains(k, "rule_level")))
    parts = by_host.attach(by_rule.attach(parts, "rule_level"), "host_level")
    best = parts.withColumn("best", F.get(fits, F.lit(0)))
    names = F.create_map(*[F.lit(x) for k, (name, _) in own.items() for x in (k, name)])
    verdicts = F.create_map(*[F.lit(x) for k, (_, v) in own.items() for x in (k, v)])
    mirrored = (F.col("host") != "") & by_host.contains(F.col("host"), "host_level")
    return best.select("page_id", "host", "path", F.element_at(names, F.col("best")).alias("rule"),
                       F.coalesce(F.element_at(verdicts, F.col("best")),
                                  F.when(mirrored, "block").otherwise("allow")).alias("verdict"))


ORACLE = r"""
WITH u AS (SELECT page_id, translate(COALESCE(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  COALESCE(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, md5(COALESCE(html, '')) AS digest FROM pages),
t AS (SELECT digest, MIN(host) <> MAX(host) AS twice FROM u GROUP BY digest),
m AS (SELECT host, bool_and(twice) AS listed FROM (SELECT DISTINCT host, digest FROM u) JOIN t USING (digest) GROUP BY host),
r(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
f AS (SELECT page_id, arg_max(h || p, length(h) * 1000 + length(p)) AS rule, arg_max(v, length(h) * 1000 + length(p)) AS v
  FROM u, r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT u.page_id, u.host, u.path, f.rule, COALESCE(f.v, CASE WHEN u.host <> '' AND m.listed THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN f USING (page_id) LEFT JOIN m ON u.host = m.host
"""
