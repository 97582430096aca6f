from harborlake.plans.analytics import (
    airport_types_by_state,
    arrivals_by_port_month,
    arrivals_with_temperature,
    port_demographics,
    temperature_trend,
    top_ports,
)
from harborlake.plans.pipeline import (
    Extract,
    Locations,
    TableResult,
    land_extracts,
    pipeline_report,
    read_ports,
    register_views,
    run_pipeline,
)
from harborlake.plans.quality import (
    QualityError,
    check_ports,
    duplicate_report,
    port_conflicts,
    row_counts,
    unmatched_report,
    write_checked,
    write_checked_version,
)
from harborlake.plans.tables import (
    build_airports,
    build_arrivals,
    build_city_demographics,
    build_land_temperatures,
    build_ports,
)

__all__ = [
    "Extract",
    "Locations",
    "QualityError",
    "TableResult",
    "airport_types_by_state",
    "arrivals_by_port_month",
    "arrivals_with_temperature",
    "build_airports",
    "build_arrivals",
    "build_city_demographics",
    "build_land_temperatures",
    "build_ports",
    "check_ports",
    "duplicate_report",
    "land_extracts",
    "pipeline_report",
    "port_conflicts",
    "port_demographics",
    "read_ports",
    "register_views",
    "row_counts",
    "run_pipeline",
    "temperature_trend",
    "top_ports",
    "unmatched_report",
    "write_checked",
    "write_checked_version",
]
