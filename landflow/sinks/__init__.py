from landflow.sinks.tables import (  # noqa: F401
    EmptyInput,
    apply_empty_policy,
    ensure_schema,
    replace_partition,
    save_tables,
    sink_cast,
    write_full_refresh,
)
