"""Sensors."""

from cairn.operators.projection import StagingSpec

SYSTEM = "trafficcount"

# Source columns with their types, and the names the outputs carry.
DELETED = {"_is_deleted": "is_deleted"}
MODELS = {
    "derived_visitor_metrics": StagingSpec(
        SYSTEM, "derived_visitor_metrics", "hk_visitor_metric", "metric_id",
        {"metric_id": "string", "sensor_id": "string", "target_date": "date",
         "estimated_total_visitors": "int", "vehicle_multiplier_used": "decimal(3,2)",
         "calculation_timestamp": "timestamp_ntz", "_is_deleted": "boolean"}, DELETED),
    "pedestrian_cyclist_counts": StagingSpec(
        SYSTEM, "pedestrian_cyclist_counts", "hk_pedestrian_cyclist_count", "count_id",
        {"count_id": "string", "sensor_id": "string", "timestamp_hour": "timestamp_ntz",
         "raw_pedestrian_count": "int", "raw_cyclist_count": "int", "is_anomaly": "boolean",
         "_is_deleted": "boolean"}, DELETED),
    "sensor_locations": StagingSpec(
        SYSTEM, "sensor_locations", "hk_sensor", "sensor_id",
        {"sensor_id": "string", "park_id": "string", "installation_date": "date",
         "sensor_type": "string", "location_description": "string", "status": "string",
         "_is_deleted": "boolean"}, DELETED),
    "vehicle_counts": StagingSpec(
        SYSTEM, "vehicle_counts", "hk_vehicle_count", "count_id",
        {"count_id": "string", "sensor_id": "string", "timestamp_hour": "timestamp_ntz",
         "raw_vehicle_count": "int", "is_anomaly": "boolean", "_is_deleted": "boolean"},
        DELETED),
}
