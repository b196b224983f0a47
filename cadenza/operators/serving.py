"""Single-user recommendation from stored factors.

A store keeps user factors, user names and seen pairs as tables bucketed by the key that a request comes with, one file a bucket, so that a lookup
reads one bucket whatever the number of users: by name it reads one bucket of names, then one of factors. Items (factors, names, prior) are
one Parquet table that a request scores once. The layout is a row of JSON next to the tables; ``Store.open`` declares them again in any
session.
"""

from __future__ import annotations

import json
import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.ranking import lookup_user
from cadenza.operators.scoring import user_topk

BUCKETS = 64


class Store:
    """``tables``: names in the session's catalog. All lookups go through filters on the bucket key, which Spark prunes by."""

    def __init__(self, spark: SparkSession, path: str, layout: dict):
        self.spark, self.path, self.layout, self.tables = spark, path, layout, {}
        for name, (columns, key) in layout["tables"].items():
            self.tables[name] = f"{layout['name']}_{name}"
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self.tables[name]} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                      f"INTO {layout['buckets']} BUCKETS LOCATION '{path}/{name}'")

    @classmethod
    def save(cls, spark: SparkSession, path: str, users: DataFrame, items: DataFrame, seen: DataFrame | None = None, buckets: int = BUCKETS) -> "Store":
        """Writes a store. ``users``: id, name, features; ``items``: id, name, features and prior (0 to 1); ``seen``: user_id, item_id."""
        kinds = {c: users.schema[c].dataType.simpleString() for c in ("id", "name")}
        pairs = seen if seen is not None else spark.createDataFrame([], f"user_id {kinds['id']}, item_id {items.schema['id'].dataType.simpleString()}")
        parts = {"users": (users.select("id", "name", F.col("features").cast("array<double>").alias("features")), "id"),
                 "names": (users.select("name", "id"), "name"), "seen": (pairs.select("user_id", "item_id"), "user_id")}
        name = f"store_{uuid.uuid4().hex}"
        layout = {"name": name, "buckets": buckets, "tables": {}}
        for part, (df, key) in parts.items():
            write = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", f"{path}/{part}")
            write.mode("overwrite").saveAsTable(f"{name}_{part}")
            layout["tables"][part] = [", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), key]
        items.select("id", "name", F.col("features").cast("array<double>").alias("features"), F.col("prior").cast("double").alias("prior")).write.mode("overwrite").parquet(f"{path}/items")
        spark.createDataFrame([(json.dumps(layout),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/layout")
        return cls(spark, path, layout)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "Store":
        return cls(spark, path, json.loads(spark.read.text(f"{path}/layout").first()[0]))

    def users(self, user_id) -> DataFrame:
        """The rows of one user id: one bucket."""
        table = self.spark.table(self.tables["users"])
        return table.where(F.col("id") == F.lit(user_id).cast(table.schema["id"].dataType))

    def id_of(self, username: str):
        """The id of a user's name: one bucket. A name that is absent or ambiguous is an error."""
        return lookup_user(self.spark.table(self.tables["names"]).withColumnsRenamed({"name": "username", "id": "user_id"}), username=username).first()["user_id"]

    def seen(self, user_id) -> DataFrame:
        table = self.spark.table(self.tables["seen"])
        return table.where(F.col("user_id") == F.lit(user_id).cast(table.schema["user_id"].dataType))

    def recommend(self, k: int, user_id=None, username: str | None = None, cosine: bool = True, blend: float = 0.0, with_seen: bool = False) -> DataFrame:
        """The top k items of one user, by id or by name: user_id, item_id, name, score, rank (0-based). ``cosine`` or dot product; ``blend``: the
        share of the prior; ``with_seen``: seen items stay."""
        if (user_id is None) == (username is None):
            raise ValueError("give user_id or username")
        user_id = self.id_of(username) if user_id is None else user_id
        one = lookup_user(self.users(user_id).withColumnRenamed("id", "user_id"), user_id=user_id).withColumnRenamed("user_id", "id")
        items = self.spark.read.parquet(f"{self.path}/items")
        top = partial(user_topk, one.select("id", "features"), items.select("id", "features"), k, cosine=cosine, blend=blend,
                      prior=items.select(F.col("id").alias("item_id"), "prior") if blend > 0 else None)
        best = top(seen=None if with_seen else self.seen(user_id))
        return F.broadcast(best).join(items.select(F.col("id").alias("item_id"), "name"), "item_id").select("user_id", "item_id", "name", "score", "rank")

    def drop(self) -> None:
        """Forgets the tables in the catalog; their files stay."""
        for t in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
