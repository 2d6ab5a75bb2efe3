"""DuckDB SQL that recomputes each registered query from the raw test tables.

The SQL is assembled from named CTE blocks: ``feed`` (FIXTURES.md §3) -> ``stg`` -> ``ods`` -> the
seven dimensions (ids = row_number in natural-key order, NULLs first) -> ``fact``. Reports then run
the source SQL on those CTEs, with the tie-breakers and NULL ordering the Spark side states.
"""
