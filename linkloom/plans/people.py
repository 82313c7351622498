"""Person-name disambiguation on a generic table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.similarity import person_similarity
from linkloom.operators.ranking import global_index, index_within, value_index
from linkloom.operators.similarity_join import similar_pairs
from linkloom.session import cut_lineage

# Fixed values of the fuzzy rule.
BLOCK_LETTERS, THRESHOLD = 3, 0.95


def exact_ids(df: DataFrame, name: str, out: str = "person_id") -> DataFrame:
    """Equal names in any letter case share a number, in name order from 0."""
    return value_index(df, F.upper(name), out)


def _parts(df: DataFrame) -> DataFrame:
    pieces = df.withColumn("_parts", F.split("label", " ?[.,] ?"))
    two = F.size("_parts") == 2
    return pieces.select(
        "label", "first_at", two.alias("two"),
        F.when(two, F.col("_parts")[0]).alias("surname"),
        F.when(two, F.col("_parts")[1]).alias("given"),
    )


def fuzzy_links(names: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(child, parent): every name linked to its first-ranked similar name before it.

    ``names`` holds (label, first_at).  A two-part pair above the threshold must have one
    part that itself scores above 1 - 2 (1 - threshold): the score is a weighted mean, and
    the heavier part cannot fall further.  So candidates come from surname, given name
    and whole text, each through the token join, and the person score decides.
    """
    loose = 1 - 2 * (1 - threshold)
    texts = F.explode(
        F.array(
            F.struct(F.lit(0).alias("kind"), F.col("surname").alias("text")),
            F.struct(F.lit(1).alias("kind"), F.col("given").alias("text")),
            F.struct(F.lit(2).alias("kind"), F.col("label").alias("text")),
        )
    )
    rows = (
        _parts(names).withColumn("t", texts).where(F.col("t.text").isNotNull())
        .withColumn("block", F.substring("label", 1, BLOCK_LETTERS))
    )

    def side(tag: str) -> DataFrame:
        return rows.select(
            "block", F.col("t.kind").alias("kind"), F.col("t.text").alias(f"text_{tag}"),
            F.col("label").alias(f"label_{tag}"), F.col("first_at").alias(f"at_{tag}"),
            F.col("two").alias(f"two_{tag}"), F.coalesce("given", F.lit("")).alias(f"given_{tag}"),
        )

    both = F.col("two_a") & F.col("two_b")
    nested = F.col("given_a").contains(F.col("given_b")) | F.col("given_b").contains(F.col("given_a"))
    right_kind = F.when(F.col("l.kind") == 2, ~both).otherwise(both & nested)
    pairs = similar_pairs(
        side("a"), side("b"), ["block", "kind"], "text_a", "text_b", loose,
        (F.col("at_a") < F.col("at_b")) & right_kind, one_table=True,
    )
    scored = pairs.where(person_similarity("label_a", "label_b") > threshold)
    return scored.groupBy(F.col("at_b").alias("child")).agg(F.min("at_a").alias("parent"))


def follow_links(links: DataFrame) -> DataFrame:
    """Pointer jumping: replace each parent by its own parent until only roots remain."""
    links = cut_lineage(links)
    while True:
        step = links.select(F.col("child").alias("parent"), F.col("parent").alias("next"))
        jumped = cut_lineage(
            links.join(step, "parent", "left").select(
                "child", F.coalesce("next", "parent").alias("parent"), F.col("next").isNotNull().alias("moved")
            )
        )
        moved = jumped.where("moved").limit(1).count()
        links = jumped.drop("moved")
        if not moved:
            return links


def consistent_links(links: DataFrame, names: DataFrame) -> DataFrame:
    """Drop all links of a root whose linked names include a clear mismatch.

    Within a block the person score is 0 exactly when two given names do not contain one
    another.  Containment is transitive, so a set is free of mismatches when each given
    name, by length, contains the one before it: neighbours are compared, not all pairs.
    """
    labelled = links.join(_parts(names).withColumnRenamed("first_at", "child"), "child")
    given = labelled.where("two").select("parent", "given").distinct()
    placed = index_within(given, ["parent"], [F.length("given"), F.col("given")], "at")
    placed = cut_lineage(placed)
    longer = placed.select("parent", (F.col("at") - 1).alias("at"), F.col("given").alias("longer"))
    broken = (
        placed.join(longer, ["parent", "at"])
        .where(~F.col("longer").contains(F.col("given")))
        .select("parent").distinct()
    )
    return links.join(broken, "parent", "left_anti").select("child", "parent")


def fuzzy_ids(df: DataFrame, name: str, order: list[str], out: str = "person_id", threshold: float = THRESHOLD) -> DataFrame:
    """Attach ids: rows are numbered in (upper-cased name, order); a name's id is its first
    number, or that of the root it is linked to."""
    keyed = df.withColumn("label", F.upper(name))
    numbered = global_index(keyed.select("label", *order), [F.col("label"), *[F.col(c) for c in order]], "at")
    names = cut_lineage(numbered.groupBy("label").agg(F.min("at").alias("first_at")))
    links = consistent_links(follow_links(fuzzy_links(names, threshold)), names)
    ids = names.join(links, F.col("first_at") == F.col("child"), "left").select(
        "label", F.coalesce("parent", "first_at").alias(out)
    )
    return keyed.join(ids, "label").drop("label")
