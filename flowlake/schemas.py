"""Column contracts of the raw inputs and the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

AUDIT_COLUMNS = ("loaded_at", "source_file", "source_url")


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


OD_RAW = strings("fecha", "periodo", "origen", "destino", "viajes", "viajes_km", "residencia")
ZONE_RAW = strings("ID", "Nombre", "Poblacion", "geometry")
ZONE_RELATION = strings(
    "seccion_ine", "distrito_ine", "municipio_ine", "distrito_mitma", "municipio_mitma", "gau_mitma"
)
MUNICIPALITY_RAW = strings("Id", "Codigo", "Nombre")

#: One statistical series: a dotted label and a list of observations.
SERIES_RAW = T.StructType(
    [
        T.StructField("COD", T.StringType()),
        T.StructField("Nombre", T.StringType()),
        T.StructField(
            "Data", T.ArrayType(T.StructType([T.StructField("Valor", T.DoubleType())]))
        ),
    ]
)

HOLIDAY_RAW = T.StructType(
    [
        T.StructField("startDate", T.StringType()),
        T.StructField(
            "name", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))
        ),
        T.StructField("nationwide", T.BooleanType()),
    ]
)

OD_HOURLY = T.StructType(
    [
        T.StructField("fecha", T.TimestampNTZType()),
        T.StructField("origen_zone_id", T.StringType()),
        T.StructField("destino_zone_id", T.StringType()),
        T.StructField("viajes", T.DoubleType()),
        T.StructField("viajes_km", T.DoubleType()),
        T.StructField("residencia", T.StringType()),
        T.StructField("is_weekend", T.BooleanType()),
        T.StructField("is_holiday", T.BooleanType()),
    ]
)

OD_QUALITY = T.StructType(
    [
        T.StructField("fecha", T.TimestampNTZType()),
        T.StructField("origen_zone_id", T.StringType()),
        T.StructField("destino_zone_id", T.StringType()),
        T.StructField("residencia", T.StringType()),
        T.StructField("viajes_per_capita", T.DoubleType()),
        T.StructField("km_per_capita", T.DoubleType()),
        T.StructField("flag_negative_viajes", T.BooleanType()),
        T.StructField("flag_negative_viajes_km", T.BooleanType()),
        T.StructField("z_viajes_per_capita", T.DoubleType()),
        T.StructField("flag_outlier_viajes_per_capita", T.BooleanType()),
    ]
)

TYPICAL_DAY = T.StructType(
    [
        T.StructField("origin_id", T.StringType()),
        T.StructField("destination_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("avg_trips", T.DoubleType()),
        T.StructField("avg_km", T.DoubleType()),
    ]
)
