"""Store to supervisor map (C20)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.keys import STORE_MANAGER_MARK

STORE_LIST = "array<struct<id:string>>"


def _not_a_manager() -> Column:
    """The name of the identity's own level is known and no store manager; level 1 always passes (F8)."""
    allowed = F.col("level") == 1
    for level in (2, 3, 4, 5):
        allowed = allowed | (
            (F.col("level") == level) & ~F.contains(F.col(f"identity_lv{level}_name"), F.lit(STORE_MANAGER_MARK))
        )
    return allowed


def active_supervisors(user_identity: DataFrame, enterprise_identity: DataFrame, users: DataFrame) -> DataFrame:
    """Active identities that supervise stores: (cmid, user_id, user_name, first_name, stores, level)."""
    identity = enterprise_identity.filter(
        (F.col("status") == 1) & ~F.col("is_store") & ~F.col("is_staff") & _not_a_manager()
    ).select("cmid", F.col("id").alias("enterprise_identity_id"), "level", "stores")
    linked = user_identity.filter(F.col("status") == 1).select("user_id", "enterprise_identity_id")
    people = users.filter(~F.col("is_staff")).select(
        "cmid", F.col("id").alias("user_id"), F.col("username").alias("user_name"), "first_name"
    )
    return linked.join(identity, "enterprise_identity_id").join(people, ["cmid", "user_id"])


def supervisor_map(supervisors: DataFrame, store_resources: DataFrame) -> DataFrame:
    """One supervisor per store: the highest level number wins, then the highest user id.

    Level 1 covers every store of its tenant. Only one level-1 user of a tenant can win a
    store, so that user is picked first and joined to the stores; users and stores are
    never multiplied.
    """
    person = F.struct("level", "user_id", "user_name", "first_name")
    everywhere = (
        supervisors.filter(F.col("level") == 1).groupBy("cmid").agg(F.max(person).alias("person"))
    )
    by_default = store_resources.select("cmid", F.col("showcode").alias("foreign_store_id")).join(everywhere, "cmid")
    by_list = supervisors.filter(F.col("level") != 1).select(
        "cmid", F.explode(F.from_json("stores", STORE_LIST)).alias("store"), person.alias("person")
    )
    return (
        by_list.select("cmid", F.col("store.id").alias("foreign_store_id"), "person")
        .unionByName(by_default)
        .groupBy("cmid", "foreign_store_id")
        .agg(F.max("person").alias("person"))
        .select(
            "cmid",
            "person.first_name",
            "foreign_store_id",
            F.col("person.user_id").cast("string").alias("user_id"),
            "person.user_name",
        )
    )
