"""DuckDB oracle SQL for every query key that SQL can express."""


def oracle_sql() -> dict[str, str]:
    from .io_sql import SQL as io
    from .kpi_sql import SQL as kpi
    from .quality_sql import SQL as quality
    from .measure_sql import SQL as measure
    from .report_sql import SQL as report
    out: dict[str, str] = {}
    for part in (kpi, quality, report, measure, io):
        out.update(part)
    return out
