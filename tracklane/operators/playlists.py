"""Playlists: flattening, matching, ordered sets, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklane.functions import text
from tracklane.operators.tracks import has_title_and_artist

#: The schema of a playlist as the service gives it.
SCHEMA = "id string, name string, uri string, type string, public boolean, collaborative boolean, snapshot_id string, external_urls struct<spotify: string>, tracks struct<total: int>, owner struct<id: string, display_name: string>"


def flattened(playlists: DataFrame) -> DataFrame:
    """Playlists (SCHEMA) with an id and a name, flat, with defaults: public, not collaborative, no tracks, an empty url.

    A field is null here whether it was null or left out; `read` tells them apart and comes before.
    """
    e = lambda c: F.coalesce(F.col(c), F.lit(""))
    return playlists.filter((e("id") != "") & (e("name") != "")).select(
        "id", "name", "uri", "type", F.coalesce("public", F.lit(True)).alias("public"), F.coalesce("collaborative", F.lit(False)).alias("collaborative"), "snapshot_id",
        e("external_urls.spotify").alias("url"), F.coalesce("tracks.total", F.lit(0)).alias("tracks_total"), F.col("owner.id").alias("owner_id"), F.col("owner.display_name").alias("owner_name"),
    )


#: What a field is where the service leaves it out; where it says null, it is null.
MISSING = {"id": "", "name": "", "uri": "", "type": "playlist", "snapshot_id": ""}


def read(answers: DataFrame, raw: str = "raw") -> DataFrame:
    """Playlists as SCHEMA says from `raw`, the service's JSON of one each; other columns stay. What is no object has no id.

    A left-out field gets its value of MISSING, a null one stays null; an owner, urls or tracks that are null, empty or
    no object count as left out.
    """
    v = F.col("_v")

    def field(path: str, kind: str, missing: str | None = None) -> Column:
        got = F.try_variant_get(v, path, kind)
        return got if missing is None else F.when(F.try_variant_get(v, path, "variant").isNull(), missing).otherwise(got)

    return answers.withColumn("_v", F.try_parse_json(raw)).select(
        *[c for c in answers.columns if c != raw], *[field(f"$.{k}", "string", d).alias(k) for k, d in MISSING.items()],
        *[field(f"$.{k}", "boolean").alias(k) for k in ("public", "collaborative")],
        F.struct(field("$.external_urls.spotify", "string").alias("spotify")).alias("external_urls"), F.struct(field("$.tracks.total", "int").alias("total")).alias("tracks"),
        F.struct(*[field(f"$.owner.{k}", "string", "").alias(k) for k in ("id", "display_name")]).alias("owner"),
    )


def match_key(c: Column) -> Column:
    return F.lower(text.fold(c))


def matched(tracks: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Tracks that have a title and an artist with the catalogue's least uri for them, null where there is none."""
    known = catalogue.groupBy(match_key(F.col("artist")).alias("_a"), match_key(F.col("title")).alias("_t")).agg(F.min("uri").alias("uri"))
    own = tracks.filter(has_title_and_artist(F.col("title"), F.col("artist"))).withColumn("_a", match_key(F.col("artist"))).withColumn("_t", match_key(F.col("title")))
    return own.join(known, ["_a", "_t"], "left").drop("_a", "_t")


def ordered_distinct(rows: DataFrame, group: list[str], value: str, order: str) -> DataFrame:
    """(group, value, first_at): each value once, where it first stands; minimums are taken before the shuffle."""
    return rows.groupBy(*group, value).agg(F.min(order).alias("first_at"))


def keep_last(rows: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group in `order` (put the newest first); Spark limits each task's rows before the shuffle."""
    return rows.withColumn("_rank", F.row_number().over(W.partitionBy(*group).orderBy(*order))).filter(F.col("_rank") <= n).drop("_rank")


def upsert(stored: DataFrame, fresh: DataFrame, key: str = "id", version: str = "snapshot_id") -> DataFrame:
    """(key, change): inserted, updated, unchanged or kept (not in `fresh`). An extension: the service does this itself."""
    a = stored.select(key, F.col(version).alias("_old"), F.lit(True).alias("_a"))
    b = fresh.select(key, F.col(version).alias("_new"), F.lit(True).alias("_b"))
    change = F.when(F.col("_b").isNull(), "kept").when(F.col("_a").isNull(), "inserted").when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("updated")
    return a.join(b, key, "full_outer").select(key, change.alias("change"))


def write_plan(playlists: DataFrame, sets: DataFrame) -> DataFrame:
    """(name, action, playlist_id, uris): refresh an existing playlist with all uris, or create one with each uri once; none: nothing.

    sets: (name, uris array in order).
    """
    there = playlists.groupBy("name").agg(F.min("id").alias("playlist_id"))
    out = sets.filter(F.size("uris") > 0).join(there, "name", "left")
    old = F.col("playlist_id").isNotNull()
    return out.select("name", F.when(old, "refresh").otherwise("create").alias("action"), "playlist_id", F.when(old, F.col("uris")).otherwise(F.array_distinct("uris")).alias("uris"))


def snapshot_payload(flat: DataFrame) -> DataFrame:
    """(n_playlists, payload): all flat playlists as the one snapshot that the service takes; an account's playlists, no more."""
    body = F.struct(F.array_sort(F.collect_list(F.struct(*flat.columns))).alias("playlists"))
    return flat.agg(F.count("*").alias("n_playlists"), F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"))


def upserted(responses: DataFrame, response: str = "response") -> DataFrame:
    """`responses` with upserted and unchanged from {data: {upserted, unchanged}}; both null where the answer has no count."""
    got = F.from_json(response, "data struct<upserted: bigint, unchanged: bigint>")["data"]
    return responses.withColumn("_d", got).select(
        *responses.columns, F.col("_d.upserted").alias("upserted"), F.when(F.col("_d.upserted").isNotNull(), F.coalesce("_d.unchanged", F.lit(0))).alias("unchanged")
    )
