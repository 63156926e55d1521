"""Spark views over the given tables that have the shape of the raw and derived inputs.

``workload/sql.py`` holds the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions.geo import centroid, parse_wkt
from flowlake.functions.temporal import day_key
from flowlake.plans import zones as Z
from flowlake.plans.gravity import daily_pairs, latest_year
from flowlake.session import scratch_path
from flowlake.sinks.reports import ReportParams
from flowlake.sinks.tables import replace
from flowlake.sources.files import holidays

#: Report parameters over the event days and over the line-item days.
PARAMS = ReportParams(
    "2024-01-05", "2024-01-20", "POLYGON ((-10 35, -3 35, -3 40, -10 40, -10 35))"
)
TRIANGLE = "POLYGON ((-10 35, 2 35, -10 43.3, -10 35))"
HOLED = "POLYGON ((-10 35, 3 35, 3 43, -10 43, -10 35), (-7 37, -2 37, -2 40, -7 40, -7 37))"
LARGE_PARAMS = ReportParams(
    "1996-01-01", "1999-12-31", "POLYGON ((-10 35, -3 35, -3 40, -10 40, -10 35))"
)
YEAR = "2024"


class Views:
    """The views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate that is read more than once to the shared folder, and read it back."""
        path = scratch_path(self.spark, name)
        replace(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    # -- OD flows ---------------------------------------------------------------------------

    def od_raw(self) -> DataFrame:
        """Event stream as raw OD rows."""
        user = F.col("user_id") % 29
        target = F.get_json_object("props", "$.k").cast("long") % 25
        return self.table("events").select(
            day_key(F.col("ts")).alias("fecha"),
            F.hour("ts").cast("string").alias("periodo"),
            F.when(user >= 25, "externo").otherwise(user.cast("string")).alias("origen"),
            target.cast("string").alias("destino"),
            F.ceil("value").cast("string").alias("viajes"),
            (F.col("value") * 2).cast("string").alias("viajes_km"),
            F.col("event_type").alias("residencia"),
        )

    def od_raw_large(self) -> DataFrame:
        """Line items as raw OD rows, from the customer's nation to the supplier's."""
        return (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                day_key(F.col("l_shipdate")).alias("fecha"),
                F.col("l_linenumber").cast("string").alias("periodo"),
                F.col("c_nationkey").cast("string").alias("origen"),
                F.col("s_nationkey").cast("string").alias("destino"),
                F.col("l_quantity").cast("string").alias("viajes"),
                F.col("l_extendedprice").cast("string").alias("viajes_km"),
                F.col("c_mktsegment").alias("residencia"),
            )
        )

    def holiday_raw(self) -> DataFrame:
        return self.spark.sql(
            """SELECT day AS startDate, array(named_struct('text', 'Holiday ' || day)) AS name,
                 nationwide
               FROM VALUES ('2024-01-01', true), ('2024-01-06', true), ('2024-01-22', false)
                 AS t(day, nationwide)"""
        )

    def holiday(self) -> DataFrame:
        return holidays(self.holiday_raw())

    # -- zones of the flows -----------------------------------------------------------------

    def zone_raw(self) -> DataFrame:
        """A square around a grid point for each nation."""
        k = F.col("n_nationkey")
        lon, lat = -9 + 2.5 * (k % 5), 36 + 1.5 * F.floor(k / 5)
        return self.table("nation").select(
            k.cast("string").alias("ID"),
            F.col("n_name").alias("Nombre"),
            square_wkt(lon - 0.5, lat - 0.5, F.lit(1.0)).alias("geometry"),
        )

    def zone(self) -> DataFrame:
        geometry = parse_wkt(F.col("geometry"))
        parsed = self.zone_raw().select(
            F.col("ID").alias("id"), F.col("Nombre").alias("nombre"), geometry.alias("geometry")
        )
        return parsed.withColumn("centroid", centroid(F.col("geometry")))

    def indicators(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Companies, income and population per nation."""
        people = F.count("*") * 1_000_000.0
        men = F.count_if(F.col("c_custkey") % 2 == 0) * 1_000_000.0
        zone = F.col("c_nationkey").cast("string").alias("zone_id")
        customers = self.table("customer").groupBy(zone)
        companies = (
            self.table("supplier")
            .groupBy(F.col("s_nationkey").cast("string").alias("zone_id"))
            .agg(F.count("*").cast("double").alias("empresas"))
        )
        income = customers.agg(F.max("c_acctbal").alias("renta_media"))
        population = customers.agg(
            people.alias("poblacion_total"),
            men.alias("poblacion_hombres"),
            (people - men).alias("poblacion_mujeres"),
        )
        return companies, income, population

    def gravity_inputs(self, od: DataFrame) -> dict:
        """Daily pair totals, zones, their profile of the newest year, as written tables, and that year."""
        daily = self.stored(daily_pairs(od), "daily-pairs")
        year = latest_year(daily, "date")
        profile = self.stored(self.profile(str(year)), "profile")
        return {"daily": daily, "zones": self.stored(self.zone(), "zone"), "profile": profile, "year": year}

    def broken_zone_raw(self) -> DataFrame:
        """Zones of which every fifth has a geometry text that ends too soon, and every seventh none."""
        k = F.regexp_extract("ID", r"\d+", 0).cast("long")
        broken = F.when(k % 5 == 0, "POLYGON ((0 0, 1").when(k % 7 == 0, None).otherwise(F.col("geometry"))
        return self.municipality_zone_raw().distinct().withColumn("geometry", broken)

    def profile(self, year: str = YEAR) -> DataFrame:
        return Z.zone_profile(self.zone(), *self.indicators(), year)

    # -- municipalities: one per supplier -----------------------------------------------------

    def municipality_raw(self) -> DataFrame:
        k = F.col("s_suppkey")
        suffix = F.when(k % 6 == 4, ". resto").otherwise("")
        return self.table("supplier").select(
            k.cast("string").alias("Id"),
            F.when(k % 17 != 0, F.concat(F.lit("C"), k)).alias("Codigo"),
            F.concat(place_name(k), suffix).alias("Nombre"),
        )

    def zone_relation(self) -> DataFrame:
        """Three census sections per municipality; two municipalities share a zone."""
        k = F.col("s_suppkey")
        sections = F.explode(F.sequence(F.lit(1), F.lit(3)))
        return self.table("supplier").withColumn("section", sections).select(
            F.concat(F.lit("S"), k, F.lit("-"), "section").alias("seccion_ine"),
            F.concat(F.lit("C"), k).alias("municipio_ine"),
            F.when(k % 23 != 0, F.concat(F.lit("Z"), F.floor(k / 2))).alias("municipio_mitma"),
        )

    def municipality_zone_raw(self) -> DataFrame:
        """A zone per supplier, every zone twice: a square, a square with a hole, two squares."""
        k = F.col("s_suppkey")
        x, y = (k % 97 - 9).cast("double"), (36 + k % 11).cast("double")
        hole = F.concat(
            F.lit("POLYGON ("), ring(x, y, F.lit(4.0)), F.lit(", "), ring(x + 1, y + 1, F.lit(1.0)), F.lit(")")
        )
        parts = F.concat(
            F.lit("MULTIPOLYGON (("),
            ring(x, y, F.lit(2.0)),
            F.lit("), ("),
            ring(x + 5, y, F.lit(1.0)),
            F.lit("))"),
        )
        shape = F.when(k % 3 == 0, square_wkt(x, y, F.lit(1.0))).when(k % 3 == 1, hole)
        return self.table("supplier").select(
            F.concat(F.lit("Z"), k).alias("ID"),
            F.concat(F.lit("Zone "), k).alias("Nombre"),
            shape.otherwise(parts).alias("geometry"),
            F.explode(F.sequence(F.lit(1), F.lit(2))).alias("copy"),
        ).drop("copy")

    def name_map(self) -> DataFrame:
        return Z.name_map(self.municipality_raw(), self.zone_relation())

    def companies_raw(self) -> DataFrame:
        k = F.col("s_suppkey")
        label = F.when(k % 7 == 0, ". Otros").otherwise(". Total cnae. Empresas")
        values = observations((k % 13).cast("double"), F.lit(None), (k % 5).cast("double"))
        return self.table("supplier").select(
            F.concat(place_name(k), label).alias("Nombre"),
            F.when(k % 9 == 0, observations()).otherwise(values).alias("Data"),
        )

    def population_raw(self) -> DataFrame:
        k = F.col("s_suppkey")
        kinds = F.array(*map(F.lit, ["Total", "Hombres", "Mujeres"]))
        rows = self.table("supplier").select(
            "s_suppkey", F.posexplode(kinds).alias("position", "kind")
        )
        value = (k % 101 + 10 * (2 - F.col("position"))).cast("double")
        return rows.select(
            F.concat(place_name(k), F.lit(". "), F.col("kind"), F.lit(" . Personas.")).alias("Nombre"),
            observations(value, F.lit(None)).alias("Data"),
        )

    def income_raw(self) -> DataFrame:
        k = F.col("s_suppkey")
        part = F.when(k % 8 == 0, " sección 1").when(k % 8 == 1, " Distrito 2").otherwise("")
        kind = F.when(k % 8 == 2, "Renta bruta").otherwise("Renta neta media por persona ")
        return self.table("supplier").select(
            F.concat(place_name(k), part, F.lit(". Dato base. "), kind).alias("Nombre"),
            observations(F.col("s_acctbal"), F.when(k % 4 == 3, F.col("s_acctbal") + 7)).alias("Data"),
        )

    # -- surveys and files --------------------------------------------------------------------

    def people_day_raw(self) -> DataFrame:
        return (
            self.table("events")
            .groupBy(
                day_key(F.col("ts")).alias("fecha"),
                (F.col("user_id") % 25).cast("string").alias("zona_pernoctacion"),
                F.nullif(F.col("event_type"), F.lit("error")).alias("edad"),
                F.when(F.col("user_id") % 2 == 0, "H").otherwise("M").alias("sexo"),
                F.hour("ts").cast("string").alias("numero_viajes"),
            )
            .agg(F.count("*").cast("string").alias("personas"))
        )

    def overnight_raw(self) -> DataFrame:
        return (
            self.table("events")
            .groupBy(
                day_key(F.col("ts")).alias("fecha"),
                (F.col("user_id") % 25).cast("string").alias("zona_pernoctacion"),
                F.nullif(F.get_json_object("props", "$.k").cast("long") % 25, F.lit(0))
                .cast("string")
                .alias("zona_residencia"),
            )
            .agg(F.count("*").cast("string").alias("personas"))
        )

    def feed_text(self) -> DataFrame:
        """A feed line per line item that names the file of its ship day."""
        day = F.col("l_shipdate")
        name = F.when(F.col("l_returnflag") == "N", "VIAJES_MUNICIPIOS").when(
            F.col("l_returnflag") == "A", "Viajes_municipios"
        )
        return self.table("lineitem").select(
            F.concat(
                F.lit("<item><link>https://data.example.org/estudios_basicos/por-municipios/viajes/ficheros-diarios/"),
                F.date_format(day, "yyyy-MM"),
                F.lit("/"),
                day_key(day),
                F.lit("_"),
                name.otherwise("Viajes_distritos"),
                F.lit(".csv.gz</link></item>"),
            ).alias("value")
        )

    def order_days(self) -> DataFrame:
        return self.table("orders").select(day_key(F.col("o_orderdate")).alias("fecha"))


def place_name(k: Column) -> Column:
    """Accents, hyphens, bilingual forms, an empty second form, stray spaces, homonyms."""
    number = k.cast("string")
    return (
        F.when(k % 6 == 0, F.concat(F.lit("Ávila-Norte "), number))
        .when(k % 6 == 1, F.concat(F.lit("Alacant "), number, F.lit("/Alicante "), number))
        .when(k % 6 == 2, F.concat(F.lit("Sóller "), number, F.lit("/")))
        .when(k % 6 == 3, F.concat(F.lit(" Cañón "), (k % 30).cast("string"), F.lit(" ")))
        .when(k % 6 == 4, F.concat(F.lit("Vall d'Uixó "), number))
        .otherwise(F.concat(F.lit("MÜNSTER-"), number))
    )


def observations(*values: Column) -> Column:
    kind = "array<struct<Valor:double>>"
    return F.array(*[F.struct(v.cast("double").alias("Valor")) for v in values]).cast(kind)


def ring(x: Column, y: Column, side: Column) -> Column:
    corners = [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]
    points = [F.concat_ws(" ", a.cast("string"), b.cast("string")) for a, b in corners]
    return F.concat(F.lit("("), F.concat_ws(", ", *points), F.lit(")"))


def square_wkt(x: Column, y: Column, side: Column) -> Column:
    return F.concat(F.lit("POLYGON ("), ring(x, y, side), F.lit(")"))
