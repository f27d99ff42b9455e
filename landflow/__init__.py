"""landflow: nested JSON pages landed from paged sources, made into flat,
typed tables with Spark DataFrame expressions.

Modules: ``sources.pages`` (read, unnest, cut, audit), ``operators`` (shape,
filters, links, aggregates), ``functions.scalars``, ``sinks.tables``,
``plans.pipelines`` (the table jobs), ``streaming.activity_stream``.
"""

__version__ = "0.1.0"
