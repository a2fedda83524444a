"""The derived refresh and the write path on a generated catalog of the published benchmark's size.

1.9 million by_artist, 1.3 million on_label, 1.6 million in_genre, 2.3 million
in_style and 1.6 million credited_on edges. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

from pyspark.sql import functions as F


def spread(n: int, *salt: int):
    """A skewed choice below ``n``, settled by the row's id."""
    u = F.pmod(F.xxhash64("id", *(F.lit(s) for s in salt)), F.lit(1_000_003)) / 1_000_003
    return F.floor(F.pow(u, 2.0) * n).cast("long")


def edges(spark, releases: int, artists: int, labels: int, masters: int, genres: int, styles: int):
    r = spark.range(releases).withColumn("release_id", F.col("id").cast("string"))
    some = lambda most, s: F.explode(F.sequence(F.lit(1), 1 + F.pmod(F.xxhash64("id", F.lit(s)), F.lit(most)).cast("int"))).alias("k")
    pair = lambda most, s, n, name: r.select("id", "release_id", some(most, s)).select("release_id", F.floor(F.pow(F.pmod(F.xxhash64("id", "k", F.lit(s)), F.lit(1_000_003)) / 1_000_003, 2.0) * n).cast("long").cast("string").alias(name)).distinct()
    m = spark.range(masters).withColumn("master_id", F.col("id").cast("string"))
    empty = lambda schema: spark.createDataFrame([], schema)
    out = {
        "by_artist": pair(3, 1, artists, "artist_id"),
        "on_label": pair(2, 2, labels, "label_id"),
        "in_genre": pair(3, 3, genres, "genre_name"),
        "in_style": pair(4, 4, styles, "style_name"),
        "credited_on": pair(3, 5, artists, "person_name").withColumn("role", F.lit("Producer")),
        "issued_on": r.select("release_id", F.lit("vinyl_12").alias("medium_id"), F.lit("discogs").alias("source"), F.lit(1).cast("long").alias("qty")),
        "derived_from": r.select("release_id", spread(masters, 6).cast("string").alias("master_id")),
        "credited_to": empty("release_id string, company_id string, role string, role_category string, source string"),
        "master_by_artist": m.select("master_id", spread(artists, 7).cast("string").alias("artist_id")),
        "master_in_genre": m.select("master_id", spread(genres, 8).cast("string").alias("genre_name")),
        "master_in_style": m.select("master_id", spread(styles, 9).cast("string").alias("style_name")),
        "member_of": empty("member_artist_id string, group_artist_id string"),
        "alias_of": empty("alias_artist_id string, artist_id string"),
        "same_as": empty("person_name string, artist_id string"),
    }
    vertices = {"genre": spark.range(genres).select(F.col("id").cast("string").alias("name")), "style": spark.range(styles).select(F.col("id").cast("string").alias("name")), "label": spark.range(labels).select(F.col("id").cast("string").alias("label_id"))}
    years = r.select("release_id", F.when(F.col("id") % 10 > 0, 1950 + F.col("id") % 70).cast("int").alias("year"))
    return out, vertices, years


def documents(spark, n: int):
    """Releases with credits, companies, media and tracks, as JSON."""
    pick = lambda s, m: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(m)).cast("string")
    several = lambda s, most, f: F.transform(F.sequence(F.lit(1), 1 + F.pmod(F.xxhash64("id", F.lit(s)), F.lit(most)).cast("int")), f)
    number = lambda x, s, m: F.pmod(F.xxhash64("id", x, F.lit(s)), F.lit(m)).cast("string")
    credit = lambda x: F.struct(F.concat(F.lit("Person "), number(x, 3, 9999)).alias("name"), F.lit("Producer").alias("role"), number(x, 4, 9999).alias("id"))
    body = F.struct(
        F.col("id").cast("string").alias("id"),
        several(1, 3, lambda x: F.struct(number(x, 1, 120_000).alias("id"))).alias("artists"),
        several(2, 2, lambda x: F.struct(number(x, 2, 20_000).alias("id"))).alias("labels"),
        several(5, 2, lambda x: F.concat(F.lit("Genre "), number(x, 5, 8))).alias("genres"),
        several(6, 4, lambda x: F.concat(F.lit("Style "), number(x, 6, 60))).alias("styles"),
        several(7, 14, credit).alias("extraartists"),
        F.struct(several(8, 4, lambda x: F.struct(number(x, 8, 500).alias("discogs_id"), F.lit("Pressed By").alias("role"))).alias("items")).alias("companies"),
        F.array(F.struct(F.lit("Vinyl").alias("name"), F.lit("1").alias("qty"), F.array(F.lit("LP")).alias("descriptions"))).alias("formats"),
        F.struct(several(9, 12, lambda x: F.struct(x.cast("string").alias("position"), F.struct(F.array(credit(x)).alias("artist")).alias("extraartists"))).alias("track")).alias("tracklist"),
    )
    return spark.range(n).select(F.lit("releases").alias("entity"), F.to_json(body).alias("value"), F.col("id").alias("seq"))


def main(releases: int = 1_000_000, ingested: int = 60_000) -> None:
    from lodestrata.operators import counters
    from lodestrata.session import session
    from lodestrata.sources.snapshots import SnapshotStore
    from lodestrata.streaming.ingest import Ingest

    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", int(cpus), **{"spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="bench-")
    try:
        e, v, years = edges(spark, releases, 120_000, 20_000, 250_000, 15, 440)
        sizes = {}
        for name, df in e.items():
            df.write.parquet(f"{root}/{name}")
            e[name] = spark.read.schema(df.schema).parquet(f"{root}/{name}")
            sizes[name] = e[name].count()
        seconds, made = {}, {}
        for name, df in counters.refresh(e, v, years).items():
            began = time.perf_counter()
            df.write.parquet(f"{root}/out/{name}")
            seconds[name] = round(time.perf_counter() - began, 3)
            made[name] = spark.read.parquet(f"{root}/out/{name}").count()
        events = documents(spark, ingested)
        events.write.parquet(f"{root}/events")
        ingest = Ingest(SnapshotStore(spark, f"{root}/store"))
        began = time.perf_counter()
        ingest.apply(spark.read.parquet(f"{root}/events"), 0)
        load = time.perf_counter() - began
        print(json.dumps({"metric": "derived refresh", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "rows": made, "edges": sizes, "ingest": {"releases": ingested, "sec": round(load, 1), "releases_per_s": round(ingested / load)}}))
    finally:
        shutil.rmtree(root, ignore_errors=True)


if __name__ == "__main__":
    main(*map(int, sys.argv[1:]))
