"""Schema binding: as-of join of row events to table maps, DDL invalidation, catalog names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ddl_targets
from ..types import QUERY
from .order import by_file


def ddl_places(events: DataFrame) -> DataFrame:
    """(log_file, seq, schema, table): where DDL changes which table."""
    targets = F.explode(ddl_targets(F.col("query.query"), F.col("query.schema"))).alias("t")
    # the shortest DDL, TRUNCATE t, has ten characters, so no pattern is tried on BEGIN and COMMIT
    return events.where((F.col("type") == QUERY) & F.col("query").isNotNull() & (F.length("query.query") >= 10)).select("log_file", "seq", targets).select("log_file", "seq", "t.schema", "t.table").distinct()


def invalidations(events: DataFrame) -> DataFrame:
    """(schema, table, at): the sorted places of DDL on each table."""
    return ddl_places(events).groupBy("schema", "table").agg(F.sort_array(F.collect_set("seq")).alias("at"))


def as_of(df: DataFrame, is_map: Column, value: Column, key: str = "table_id", file: str = "log_file", order: str = "seq", name: str = "map") -> DataFrame:
    """Adds the latest ``value`` of a row with ``is_map`` and the same key at or before each row.

    The window runs inside (file, key), so a hot table is cut by files; what a file inherits is
    the last value of the files before, from a table of one row per file and key that has one.
    """
    marked = df.withColumn("_v", F.when(is_map, value))
    inside = Window.partitionBy(file, key).orderBy(order)
    ends = marked.groupBy(F.col(file).alias("_file"), F.col(key).alias("_key")).agg(F.max_by(F.when(is_map, F.col("_v")), F.when(is_map, F.col(order))).alias("_last"))
    files = Window.partitionBy("_key").orderBy(*by_file("_file")).rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select("_file", "_key", F.last("_last", ignorenulls=True).over(files).alias("_before"))
    joined = marked.join(before, (marked[file] == before["_file"]) & marked[key].eqNullSafe(before["_key"]), "left")
    return joined.withColumn(name, F.coalesce(F.last("_v", ignorenulls=True).over(inside), F.col("_before"))).drop("_v", "_file", "_key", "_before")


def valid(rows: DataFrame, places: DataFrame, name: str = "map", order: str = "seq", file: str = "log_file") -> DataFrame:
    """The map becomes null where DDL on its table lies between the map and the row.

    places: (log_file, seq, schema, table), as of ``ddl_places``; an event is a row or DDL, not both.
    The last DDL before a row is looked up as its map is, so a table may have any number of them.
    """
    target = F.when(F.col(name).isNotNull(), F.struct(F.col(f"{name}.schema").alias("schema"), F.col(f"{name}.table").alias("table")))
    ddl = places.select(F.col("log_file").alias(file), F.col("seq").alias(order), F.col("seq").alias("_ddl"), F.struct("schema", "table").alias("_target"))
    both = rows.withColumn("_target", target).withColumn("_ddl", F.lit(None).cast("long")).unionByName(ddl, allowMissingColumns=True)
    found = as_of(both, F.col("_ddl").isNotNull(), F.col("_ddl"), key="_target", file=file, order=order, name="_last").where("_ddl is null")
    stale = F.coalesce(F.col("_last") > F.col(f"{name}.seq"), F.lit(False))
    return found.withColumn(name, F.when(~stale, F.col(name))).select(rows.columns)


def timeline(maps: DataFrame, ddl: DataFrame) -> DataFrame:
    """(table_id, seq, map): the places where the map in force of a table id changes, and the map from there on.

    maps: log_file, seq, table_id, map (schema, table, digest); ddl: log_file, seq, schema, table.
    A log says the same map in every transaction; only changes are kept (DDL makes it null until
    the next map), first inside each file and then over the files, so a table id has about as many
    states as its table has had schemas, and rows can look theirs up without being moved.
    """
    names = maps.select("table_id", F.col("map.schema").alias("schema"), F.col("map.table").alias("table")).distinct()
    gone = ddl.join(names, ["schema", "table"]).select("log_file", "seq", "table_id", F.lit(True).alias("ddl"), F.struct("schema", "table", F.lit(None).cast("string").alias("digest")).alias("map"))
    both = maps.select("log_file", "seq", "table_id", F.lit(False).alias("ddl"), "map").unionByName(gone)
    last = as_of(both, ~F.col("ddl"), F.col("map"), name="now")
    hits = ~F.col("ddl") | ((F.col("now.schema") == F.col("map.schema")) & (F.col("now.table") == F.col("map.table")))
    state = last.where(hits).select("log_file", "seq", "table_id", F.when(~F.col("ddl"), F.col("map")).alias("map"))

    def changes_only(df: DataFrame, *keys: str) -> DataFrame:
        along = Window.partitionBy(*keys).orderBy("seq")
        return df.withColumn("_b", F.lag(F.struct("map")).over(along)).where(F.col("_b").isNull() | ~F.col("_b.map.digest").eqNullSafe(F.col("map.digest"))).drop("_b")

    return changes_only(changes_only(state, "log_file", "table_id"), "table_id").select("table_id", "seq", "map")


def catalog_columns(catalog: DataFrame) -> DataFrame:
    """(schema, table, cols): columns of each table by their ordinal, with key flags.

    catalog: schema, table, column, ordinal, column_key (PRI, UNI or other). A primary column is unique, too.
    """
    col = F.struct("ordinal", F.col("column").alias("name"), (F.col("column_key") == "PRI").alias("pk"), F.col("column_key").isin("PRI", "UNI").alias("uk"))
    return catalog.groupBy("schema", "table").agg(F.transform(F.sort_array(F.collect_list(col)), lambda c: F.struct(c["name"].alias("name"), c["pk"].alias("pk"), c["uk"].alias("uk"))).alias("cols"))


def with_names(maps: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """Adds columns (name, type, meta, nullable, pk, uk); colN where the catalog has no such table, or another count."""
    if catalog is not None:
        known = catalog_columns(catalog)
        maps = maps.join(known, ["schema", "table"], "left")
    else:
        maps = maps.withColumn("cols", F.lit(None).cast("array<struct<name:string,pk:boolean,uk:boolean>>"))
    fits = F.coalesce(F.size("cols") == F.size("types"), F.lit(False))
    made = F.transform(
        F.arrays_zip("types", "metas", "nullable"),
        lambda t, i: F.struct(
            F.when(fits, F.try_element_at("cols", i + 1)["name"]).otherwise(F.concat(F.lit("col"), (i + 1).cast("string"))).alias("name"),
            t["types"].alias("type"), t["metas"].alias("meta"), t["nullable"].alias("nullable"),
            F.when(fits, F.try_element_at("cols", i + 1)["pk"]).otherwise(False).alias("pk"),
            F.when(fits, F.try_element_at("cols", i + 1)["uk"]).otherwise(False).alias("uk"),
        ),
    )
    return maps.withColumn("columns", made).drop("cols")
