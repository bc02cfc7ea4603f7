"""DataFrame → DataFrame operators."""

from aeris.operators.dims import (
    city_points,
    countries_dim,
    country_parameters,
    location_points,
    locations_dim,
    parameters_dim,
    provider_parameters,
    providers_dim,
    sensors_dim,
)
from aeris.operators.measurements import (
    daily_sensor_stats,
    daily_stats_of_raw_fact,
    measurements_between,
    measurements_of_sensors,
    raw_measurements,
)
from aeris.operators.profile import parameter_profile
from aeris.operators.select import active_locations, country_sensors, duplicate_keys, enrich_measurements, orphans

__all__ = [
    "active_locations",
    "city_points",
    "countries_dim",
    "country_parameters",
    "country_sensors",
    "daily_sensor_stats",
    "daily_stats_of_raw_fact",
    "duplicate_keys",
    "enrich_measurements",
    "location_points",
    "locations_dim",
    "measurements_between",
    "measurements_of_sensors",
    "orphans",
    "parameter_profile",
    "parameters_dim",
    "provider_parameters",
    "providers_dim",
    "raw_measurements",
    "sensors_dim",
]

from aeris.operators.geo import assign_communes, commune_cells  # noqa: E402

__all__ += ["assign_communes", "commune_cells"]
