"""Column names, constants and StructTypes of the data model."""

from pyspark.sql import types as T

# They must equal the ones of the data model for right results.
TOKEN_LEVELS = 17
WEATHER_DAYS = 120
WEATHER_LAG_DAYS = 2
STATION_RADIUS_KM = 100.0
EARTH_RADIUS_KM = 6371.0
MINIMUM_YEAR = 1950
KEY_RANGE_ROWS = 250
RANDOM_CATEGORY = "random"
SOURCE_KEY_SEPARATOR = "-|-"
EQUALITY_KEY_SEPARATOR = "|||"
RECORD_SUFFIX = ".tfrecords"

WEATHER_COLUMNS = ["avg_temp", "max_temp", "min_temp", "precipitation", "daylight"]
SCALED_COLUMNS = ["elevation", "min_temp", "max_temp", "daylight", "precipitation"]
TOKEN_COLUMNS = [f"s2_token_{level}" for level in range(TOKEN_LEVELS)]
VOCABULARY_COLUMNS = TOKEN_COLUMNS + ["eco_biome", "eco_num"]

OBSERVATION_FIELDS = [
    T.StructField("example_id", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
    T.StructField("elevation", T.LongType(), False),
    T.StructField("obs_date", T.DateType(), False),
    T.StructField("eco_realm", T.StringType(), False),
    T.StructField("eco_biome", T.StringType(), False),
    T.StructField("eco_num", T.StringType(), False),
    T.StructField("s2_tokens", T.ArrayType(T.StringType()), False),
]

OBSERVATION_SCHEMA = T.StructType(OBSERVATION_FIELDS)

ENRICHED_SCHEMA = T.StructType(
    OBSERVATION_FIELDS
    + [T.StructField(c, T.ArrayType(T.DoubleType()), False) for c in WEATHER_COLUMNS]
)

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("example_id", T.StringType()),
        T.StructField("FormattedDate", T.StringType()),
        T.StructField(
            "GeoFeatureSet",
            T.StructType(
                [
                    T.StructField(
                        "GeoPoint",
                        T.StructType(
                            [
                                T.StructField("latitude", T.DoubleType()),
                                T.StructField("longitude", T.DoubleType()),
                            ]
                        ),
                    ),
                    T.StructField("Elevation", T.DoubleType()),
                    T.StructField("EcoRealm", T.IntegerType()),
                    T.StructField("EcoBiome", T.IntegerType()),
                    T.StructField("EcoNum", T.IntegerType()),
                    T.StructField("S2Tokens", T.MapType(T.StringType(), T.StringType())),
                    T.StructField("ModifiedAt", T.LongType()),
                ]
            ),
        ),
    ]
)
