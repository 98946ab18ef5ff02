"""Names, labels, thresholds and formats that outputs must carry.

Nothing here is logic. The texts are Spanish because the published tables,
dashboards and messages are.
"""

# --- fixed values: column lists ------------------------------------------------
SOURCE_COLUMNS = (
    "id",
    "sensor_id",
    "temperature",
    "humidity",
    "pressure",
    "timestamp",
    "pm25",
    "light",
    "uv_level",
    "rain_raw",
    "wind_raw",
    "vibration",
    "location",
)
LINEAGE_COLUMNS = ("ingestion_timestamp", "batch_id")
MEAN_IMPUTED_COLUMNS = ("temperature", "humidity", "pressure", "pm25", "light")
MEDIAN_IMPUTED_COLUMNS = ("temperature", "humidity", "pressure")
READING_KEY = ("sensor_id", "timestamp")

# --- fixed values: placeholders and name patterns -----------------------------
UNKNOWN_LOCATION = "Unknown"
UNKNOWN_SENSOR = "Unknown"
STATION_NAME = "Estación"
SENSOR_NAME_PREFIX = "Sensor "
BATCH_PREFIX = "batch_"
BATCH_TIME_FORMAT = "yyyyMMdd_HHmmss"
INITIAL_BATCH_PATTERN = "initial_batch_%04d"
MONTH_FORMAT = "yyyyMM"

# --- fixed values: validity and outliers --------------------------------------
VALID_RANGES = {
    "temperature": (-50, 70),
    "humidity": (0, 100),
    "pressure": (800, 1200),
}
OUTLIER_SIGMAS = 5
ANOMALY_SIGMAS = 3
LATEST_BATCHES = 8
PAGE_SIZE = 1000
POLL_LIMIT = 100
RETENTION_DAYS = 30

# --- fixed values: derived measures -------------------------------------------
FAHRENHEIT_SCALE, FAHRENHEIT_OFFSET = 1.8, 32
COMFORT_TEMPERATURE = (20, 25)
COMFORT_HUMIDITY = (40, 60)
TOLERABLE_TEMPERATURE = (18, 28)
TOLERABLE_HUMIDITY = (30, 70)
COMFORT_LABELS = ("Comfortable", "Uncomfortable", "Moderate")
QUALITY_SCORES = (100, 75, 50, 25)
HIGH_QUALITY = 90
COMPLETE_QUALITY = 100
SENSOR_CATEGORIES = {"TEMP": "Temperature", "HUM": "Humidity", "PRES": "Pressure"}
OTHER_CATEGORY = "Multi-sensor"

# --- fixed values: air quality and system state -------------------------------
# (lower bound, exclusive) -> label, highest first
AIR_QUALITY_FIVE = ((150, "Peligroso"), (100, "Muy insalubre"), (50, "Insalubre"), (25, "Moderado"))
AIR_QUALITY_FIVE_ELSE = "Bueno"
# (upper bound, inclusive) -> label, lowest first
AIR_QUALITY_FOUR = ((12, "Buena"), (35.4, "Moderada"), (55.4, "Insalubre para grupos sensibles"))
AIR_QUALITY_FOUR_ELSE = "Insalubre"
# (lower bound, inclusive) -> label, highest first
SYSTEM_STATUS = ((95, "EXCELENTE"), (80, "BUENO"))
SYSTEM_STATUS_ELSE = "REQUIERE ATENCIÓN"

# --- fixed values: alert limits -----------------------------------------------
HIGH_TEMPERATURE = 30
LOW_TEMPERATURE = 10
LOW_TEMPERATURE_NOTEBOOK = 5
HIGH_HUMIDITY = 80
LOW_HUMIDITY = 20
HIGH_PM25 = 100
LOW_PRESSURE, HIGH_PRESSURE = 950, 1050

# --- fixed values: dashboard bands, lower bound inclusive ---------------------
# metric -> (label below the first bound, ((bound, label), ...))
DASHBOARD_BANDS = {
    "temperature": ("blue", ((15, "green"), (25, "yellow"), (35, "red"))),
    "humidity": ("red", ((30, "yellow"), (50, "green"), (80, "blue"))),
    "pressure": ("purple", ()),
    "light": ("dark-blue", ((500, "yellow"), (1000, "orange"))),
    "pm25": ("green", ((35, "yellow"), (55, "red"))),
    "pm25_gauge": ("green", ((35, "yellow"), (55, "orange"), (75, "red"))),
}
SENSOR_MEAN_NAMES = {"temperature": "temp_promedio", "humidity": "humidity_promedio"}
DASHBOARD_METRIC, DASHBOARD_EXTREMES = "Metrica", ("Minimo", "Promedio", "Maximo")
DASHBOARD_METRIC_NAMES = {"temperature": "Temperatura", "humidity": "Humedad", "pressure": "Presion"}
DASHBOARD_COLUMN_NAMES = {
    "inserted_at": "Tiempo",
    "sensor_id": "Sensor",
    "temperature": "Temp",
    "humidity": "Hum",
    "pressure": "Pres",
    "light": "Luz",
    "pm25": "PM25",
}

# --- fixed values: long KPI rows ----------------------------------------------
# key -> (kpi_name, kpi_category, kpi_unit, description)
# "{}" takes the sensor, the location or the location's slug.
GENERAL_KPIS = {
    "readings": ("total_readings", "general", "count", "Número total de lecturas de sensores"),
    "sensors": ("active_sensors", "general", "count", "Número de sensores únicos activos"),
    "avg_temperature": ("avg_temperature_global", "general", "celsius", "Temperatura promedio global"),
    "avg_humidity": ("avg_humidity_global", "general", "percent", "Humedad promedio global"),
    "avg_pressure": ("avg_pressure_global", "general", "hpa", "Presión promedio global"),
}
SENSOR_KPIS = {
    "avg_temperature": ("avg_temperature_{}", "sensor", "celsius", "Temperatura promedio del sensor {}"),
    "max_temperature": ("max_temperature_{}", "sensor", "celsius", "Temperatura máxima del sensor {}"),
    "min_temperature": ("min_temperature_{}", "sensor", "celsius", "Temperatura mínima del sensor {}"),
    "readings": ("readings_count_{}", "sensor", "count", "Número de lecturas del sensor {}"),
}
LOCATION_KPIS = {
    "sensors": ("sensors_in_{}", "location", "count", "Número de sensores en {}"),
    "avg_temperature": ("avg_temperature_{}", "location", "celsius", "Temperatura promedio en {}"),
}
TEMPORAL_KPIS = {
    "last_24h": ("readings_last_24h", "temporal", "count", "Lecturas en las últimas 24 horas"),
    "last_week": ("readings_last_week", "temporal", "count", "Lecturas en la última semana"),
}
QUALITY_KPIS = {
    "avg_quality": ("avg_data_quality", "quality", "score", "Puntuación promedio de calidad de datos"),
    "high_quality": ("high_quality_readings", "quality", "count", "Lecturas con alta calidad (>=90)"),
}
COMPLETENESS_KPIS = {
    "temperature": ("completeness_temperature", "quality", "percent", "Porcentaje de completitud para temperature"),
    "humidity": ("completeness_humidity", "quality", "percent", "Porcentaje de completitud para humidity"),
    "pressure": ("completeness_pressure", "quality", "percent", "Porcentaje de completitud para pressure"),
}
ALERT_KPIS = {
    "high_temperature": ("high_temperature_alerts", "alerts", "count", "Alertas de temperatura alta (>30°C)"),
    "low_temperature": ("low_temperature_alerts", "alerts", "count", "Alertas de temperatura baja (<10°C)"),
    "high_humidity": ("high_humidity_alerts", "alerts", "count", "Alertas de humedad alta (>80%)"),
    "low_humidity": ("low_humidity_alerts", "alerts", "count", "Alertas de humedad baja (<20%)"),
}

# --- fixed values: wide KPI row, column order ---------------------------------
WIDE_KPI_COLUMNS = (
    "timestamp",
    "generation_time",
    "total_readings",
    "unique_sensors",
    "temperature_avg",
    "temperature_max",
    "temperature_min",
    "temperature_std",
    "humidity_avg",
    "humidity_max",
    "humidity_min",
    "pm25_avg",
    "pm25_max",
    "air_quality_category",
    "pressure_avg",
    "pressure_max",
    "pressure_min",
    "alerts_json",
)
