"""Geographic register."""

from cairn.operators.projection import StagingSpec

SYSTEM = "geoparks"

# Source columns with their types, and the names the outputs carry.
MODELS = {
    "infrastructure_features": StagingSpec(
        SYSTEM, "infrastructure_features", "hk_infrastructure_features", "feature_id",
        {"feature_id": "string", "geo_park_id": "string", "feature_class": "string",
         "sub_type": "string", "status": "string", "installation_year": "int",
         "geometry_wkt": "string", "positional_accuracy_meters": "decimal(5,2)",
         "last_updated": "date"}),
    "parks_master": StagingSpec(
        SYSTEM, "parks_master", "hk_parks_master", "geo_park_id",
        {"geo_park_id": "string", "gis_steward": "string", "park_name": "string",
         "total_acres": "decimal(10,2)"}),
}
