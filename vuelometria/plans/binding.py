"""Order, customer and event tables read as the flight, weather and incident feeds.

The test tables are no flight data. Each domain table is a projection of them, chosen so that
every status, class and NULL path occurs. The whole tables are bound, row for row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bitmaps import Codes, codes_of
from . import daily, facts, marts, staging

# Columns the binding uses. Given schemas save the reader a look into the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, "
    "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
FACTS = ("fct_vuelos", "fct_incidentes", "fct_clima_diario")


class _Lazy(Mapping):
    """Frames that are built when they are asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = builders

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def __contains__(self, name: object) -> bool:
        return name in self._builders


def _mod(column: str, n: int) -> Column:
    return F.col(column) % n


class BoundTables:
    """Lazily built domain tables over the Parquet files in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    # feeds

    @cached_property
    def flights(self) -> DataFrame:
        quantity = F.floor("l_quantity")
        slot = _mod("s_suppkey", 4)
        origin = self.source("nation").select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("from_name"), "n_regionkey"
        )
        target = self.source("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("to_name")
        )
        region = self.source("region").select(
            F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("origin_city")
        )
        suppliers = self.source("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), "s_suppkey", "s_name", "s_nationkey"
        )
        customers = self.source("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        # Customers go onto the orders, so the line items are shuffled once, by order. The small
        # tables are joined one by one: Catalyst knows their file sizes, but not those of a join.
        orders = (
            self.source("orders")
            .select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
            .join(customers, "o_custkey")
            .join(target, "c_nationkey")
        )
        joined = (
            self.source("lineitem")
            .join(orders, "l_orderkey")
            .join(suppliers, "l_suppkey")
            .join(origin, "s_nationkey")
            .join(region, "n_regionkey")
        )
        status = (
            F.when(F.col("l_discount") > 0.095, "cancelled")
            .when(F.col("l_tax") > 0.075, "diverted")
            .when(F.col("o_orderstatus") == "F", "Landed")
            .when(F.col("o_orderstatus") == "O", "scheduled")
            .otherwise("active")
        )
        returned = F.when(slot < 2, quantity - 40).otherwise(quantity * 5)
        plain = F.when(slot == 0, quantity - 30).otherwise(quantity - 10)
        departure = F.when(F.col("l_returnflag") == "R", returned).when(F.col("l_returnflag") == "N", plain)
        arrival = F.when(F.col("l_linestatus") == "F", quantity - 5)
        date = F.col("l_shipdate").cast("date")
        return joined.select(
            date.alias("flight_date"),
            status.alias("flight_status"),
            F.concat(F.lit("Airport "), "from_name").alias("departure_airport"),
            F.col("from_name").alias("departure_iata"),
            date.cast("string").alias("departure_scheduled"),
            departure.cast("int").alias("departure_delay_min"),
            F.concat(F.lit("Airport "), "to_name").alias("arrival_airport"),
            F.col("to_name").alias("arrival_iata"),
            date.cast("string").alias("arrival_scheduled"),
            arrival.cast("int").alias("arrival_delay_min"),
            F.col("s_name").alias("airline_name"),
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("airline_iata"),
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
                "flight_number"
            ),
            "origin_city",
        )

    @cached_property
    def weather(self) -> DataFrame:
        customers = self.source("customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
        )
        nations = self.source("nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
        places = (
            self.source("orders")
            .join(customers, "o_custkey")
            .join(nations, "n_nationkey")
            .join(self.source("region").withColumnRenamed("r_name", "city"), "r_regionkey")
        )
        key, who, rank = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
        rough = rank <= "2-HIGH"

        def number(value: Column, kind: str = "double") -> Column:
            return value.cast(kind)

        even = key % 2 == 0
        texts = {
            "1-URGENT": ("Thunderstorm", "Heavy snow"),
            "2-HIGH": ("Patchy rain", "Blizzard"),
            "3-MEDIUM": ("Partly cloudy", "Overcast"),
            "4-NOT SPECIFIED": ("Sunny", "Clear"),
        }
        condition = F.when(key % 7 != 0, "Fog")
        for level, (first, second) in texts.items():
            condition = F.when(rank == level, F.when(even, first).otherwise(second)).otherwise(condition)
        date = F.col("o_orderdate").cast("date")
        temp = number(key % 35)
        return places.select(
            key.alias("oid"),
            date.alias("weather_date"),
            "city",
            F.col("city").alias("region"),
            F.lit("XX").alias("country"),
            F.lit(0.0).alias("latitude"),
            F.lit(0.0).alias("longitude"),
            date.cast("string").alias("local_time"),
            temp.alias("temp_c"),
            (temp * 1.8 + 32.0).alias("temp_f"),
            number(40 + who % 60, "int").alias("humidity"),
            number(F.when(rough, who % 70).otherwise(who % 50)).alias("wind_kph"),
            F.lit("N").alias("wind_direction"),
            number(990 + key % 40).alias("pressure_mb"),
            number(F.when(rough, key % 13).otherwise(key % 9)).alias("precip_mm"),
            number(F.when(rough, key % 97).otherwise(key % 80), "int").alias("cloud_coverage"),
            F.when(key % 11 == 0, F.lit(None).cast("double"))
            .when(rough, number(key % 15))
            .when(rank == "5-LOW", number(3 + key % 3))
            .otherwise(number(5 + key % 10))
            .alias("visibility_km"),
            condition.alias("condition"),
            number(F.when(rank == "3-MEDIUM", 60 + who % 41).otherwise(who % 101), "int").alias("chance_of_rain"),
        )

    @cached_property
    def delays(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        urgency = F.when(F.col("value") > 150, " critical").when(F.col("value") > 100, " URGENT").otherwise("")
        offset = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
        return self.source("events").select(
            F.date_add(F.lit("1998-01-01").cast("date"), offset).alias("report_date"),
            F.col("event_id").alias("incident_id"),
            "user_id",
            F.concat("event_type", urgency).alias("incident_title"),
            F.when(k % 10 != 0, k % 2 == 1).alias("is_resolved"),
            # kept for the incident fact
            F.col("event_type").alias("motivo"),
            F.floor("value").cast("int").alias("minutos"),
        )

    # models

    @cached_property
    def stg_flights(self) -> DataFrame:
        return staging.stg_flights(self.flights)

    @cached_property
    def stg_weather(self) -> DataFrame:
        return staging.stg_weather(self.weather)

    @cached_property
    def stg_delays(self) -> DataFrame:
        return staging.stg_delays(self.delays)

    @cached_property
    def flight_codes(self) -> Mapping[str, Codes]:
        """The small tables are the dictionaries of the codes."""
        airlines = self.source("supplier").select(
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("value"), F.col("s_suppkey").alias("code")
        )
        airports = self.source("nation").select(F.col("n_name").alias("value"), F.col("n_nationkey").cast("long").alias("code"))
        of_airports = codes_of(airports)
        return {"airline_iata": codes_of(airlines), "departure_iata": of_airports, "arrival_iata": of_airports}

    @cached_property
    def flight_state(self) -> DataFrame:
        return daily.flight_state(self.stg_flights, self.flight_codes)

    @cached_property
    def int_flights_daily(self) -> DataFrame:
        return daily.flights_daily_from_state(self.flight_state)

    @cached_property
    def int_weather_daily(self) -> DataFrame:
        return daily.int_weather_daily(self.stg_weather)

    @cached_property
    def int_delays_daily(self) -> DataFrame:
        return daily.int_delays_daily(self.stg_delays)

    @cached_property
    def incidents_per_day(self) -> DataFrame:
        return daily.incidents_per_day(self.stg_delays)

    @cached_property
    def dim_fecha(self) -> DataFrame:
        return marts.dim_fecha(self.stg_flights, self.stg_weather, self.stg_delays, ordered=False)

    @cached_property
    def dim_aerolinea(self) -> DataFrame:
        return marts.dim_aerolinea(self.stg_flights)

    @cached_property
    def airport_cities(self) -> DataFrame:
        """City of an airport: here the region of the nation."""
        return (
            self.source("nation")
            .select(F.col("n_name").alias("airport_iata"), F.col("n_regionkey").alias("r_regionkey"))
            .join(self.source("region"), "r_regionkey")
            .select("airport_iata", F.col("r_name").alias("ciudad"))
        )

    @cached_property
    def dim_aeropuerto(self) -> DataFrame:
        return marts.dim_aeropuerto(self.stg_flights)

    @cached_property
    def dim_condicion_clima(self) -> DataFrame:
        return marts.dim_condicion_clima(self.stg_weather)

    # dashboard facts

    @cached_property
    def fct_clima_diario(self) -> DataFrame:
        return facts.fct_clima_diario(self.stg_weather)

    @cached_property
    def fct_vuelos(self) -> DataFrame:
        return facts.fct_vuelos(self.flights, self.fct_clima_diario)

    @cached_property
    def fct_incidentes(self) -> DataFrame:
        closed = F.col("is_resolved")
        enriched = self.delays.select(
            "*",
            F.concat(F.lit("Supplier#"), F.lpad((F.col("user_id") % 10).cast("string"), 9, "0")).alias("airline_name"),
            F.when(closed, (1 + F.col("incident_id") % 5).cast("double")).alias("satisfaccion_cliente"),
            F.when(closed, (1 + F.col("incident_id") % 48).cast("double")).alias("tiempo_resolucion_horas"),
        )
        return facts.fct_incidentes(
            enriched,
            {
                "incidente_id": "incident_id", "fecha": "report_date", "agente_id": "user_id",
                "minutos_retraso_asociado": "minutos",
            },
        )

    @property
    def facts(self) -> Mapping[str, DataFrame]:
        return _Lazy({name: partial(getattr, self, name) for name in FACTS})

    @property
    def dims(self) -> Mapping[str, DataFrame]:
        return _Lazy(
            {
                "dim_fecha": lambda: self.dim_fecha,
                "dim_aeropuerto": lambda: facts.airport_city(self.dim_aeropuerto, self.airport_cities),
            }
        )
