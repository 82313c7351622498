"""Organisation disambiguation: names, word statistics, blocks, matches, clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.names import expand_id, padded_id
from linkloom.functions.similarity import jarow_batch, letter_marks
from linkloom.functions.text import without_spaces
from linkloom.operators.aggregates import spread_limit
from linkloom.operators.components import connected_components, star_links
from linkloom.operators.lookup import find_text, map_values
from linkloom.operators.ranking import global_index
from linkloom.operators.similarity_join import may_exceed, similar_pairs
from linkloom.operators.update_join import update_join
from linkloom.session import cut_lineage

# Fixed values of the matching rules.
CLOSE, BOTH_CLOSE, MISSPELLING = 0.95, 0.90, 0.95
MISSPELLING_MIN_LENGTH = 5
BLOCK_LETTERS, BLOCK_WORDS, BLOCK_WORD_LENGTH = 2, 4, 4
TAIL_LENGTH, TAIL_WORDS = 25, 2


def attach_authority(df: DataFrame, name: str, authority: DataFrame, key: str, value: str, column: str) -> DataFrame:
    """Authority ids by exact cleaned name; negative ids mean none."""
    updated = update_join(df, authority, {name: key}, {column: value}, [value])
    return updated.withColumn(column, F.when(F.col(column) >= 0, F.col(column)))


def name_table(df: DataFrame, name: str, authority: str | None = None) -> DataFrame:
    """Distinct names with frequency and an initial id.

    Names with an authority id get ``A...``; the others ``H...`` with their position
    by frequency (then name).
    """
    asg = F.min(authority) if authority else F.min(F.lit(None).cast("long"))
    names = (
        df.where(F.col(name) != "")
        .groupBy(F.col(name).alias("name"))
        .agg(asg.alias("asg"), F.count(F.lit(1)).alias("cnt"))
    )
    numbered = global_index(names, [F.col("cnt").desc(), F.col("name")], "place", start=1)
    own = padded_id(F.lit("H"), F.col("place"))
    known = padded_id(F.lit("A"), F.col("asg"))
    return numbered.withColumn("org_id", F.when(F.col("asg").isNotNull(), known).otherwise(own))


def word_table(names: DataFrame) -> DataFrame:
    """(word, word1, count, count_f): occurrences over distinct names, and weighted by name frequency."""
    words = names.select(F.explode(F.split("name", " ")).alias("word"), "cnt")
    return words.groupBy("word").agg(
        F.count(F.lit(1)).alias("count"), F.sum("cnt").alias("count_f")
    ).select("word", F.substring("word", 1, 2).alias("word1"), "count", "count_f")


def frequent_words(words: DataFrame) -> DataFrame:
    """(word, freq): words above mean plus three deviations, and rarer near-misspellings of them."""
    limited = words.withColumn("cutoff", spread_limit(words, "count").scalar())
    top = limited.where(F.col("count") > F.col("cutoff"))
    rare = limited.where(
        (F.col("count") < F.col("cutoff")) & (F.length("word") >= MISSPELLING_MIN_LENGTH)
    ).select("word1", F.col("word").alias("rare"), F.col("count").alias("rare_count"))
    known = top.select("word1", F.col("word").alias("known"), F.col("count").alias("freq"))
    near = similar_pairs(
        rare, known, ["word1"], "rare", "known", MISSPELLING, F.col("rare_count") < F.col("freq")
    )
    best = near.groupBy(F.col("rare").alias("word")).agg(
        F.min_by("freq", F.struct(-F.col("similarity"), "known")).alias("freq")
    )
    return best.unionByName(top.select("word", F.col("count").alias("freq")))


def name_features(names: DataFrame, words: DataFrame, frequent: DataFrame) -> DataFrame:
    """Stripped and ordered names, three blocks and word-frequency strings per name.

    Words are joined to their statistics one row each and travel under the number of their
    name; what is gathered again is the words of one name.
    """
    pieces = names.select("place", F.posexplode(F.split("name", " ")).alias("pos", "word"))
    stats = words.select("word", "count", "count_f").join(frequent, "word", "left")
    rated = pieces.join(stats, "word").select("place", F.struct("pos", "word", "freq", "count", "count_f").alias("item"))
    gathered = rated.groupBy("place").agg(F.array_sort(F.collect_list("item")).alias("w")).withColumn("cutoff", spread_limit(words, "count").scalar())
    digits = "x.word rlike '^[0-9]+$'"
    kept = f"transform(filter(w, x -> {digits} OR x.freq IS NULL), x -> x.word)"
    plain = f"exists(w, x -> x.freq IS NULL AND NOT ({digits}))"
    # the rarest of the frequent words, first one on ties
    low = (
        f"array_sort(transform(filter(w, x -> x.freq IS NOT NULL AND NOT ({digits})), "
        "x -> struct(x.freq, x.pos, x.word)))"
    )
    stripped = f"rtrim(array_join(IF({plain}, {kept}, concat({kept}, array(coalesce(get({low}, 0).word, '')))), ' '))"
    ordered = "array_sort(transform(w, x -> struct(coalesce(x.freq, x.count) AS order_freq, x.word AS word)))"
    dropped = "least(size(w) DIV 2, size(filter(w, x -> coalesce(x.freq, x.count) > cutoff)))"
    long_words = f"transform(filter(w, x -> length(x.word) >= {BLOCK_WORD_LENGTH}), x -> substring(x.word, 1, {BLOCK_LETTERS}))"
    return (
        names.join(gathered, "place")
        .select(*names.columns, "w", "cutoff")
        .withColumn("name2", F.expr(stripped))
        .withColumn("_ordered", F.expr(ordered))
        .withColumn("name3", F.expr(f"array_join(transform(slice(_ordered, 1, size(w) - {dropped}), x -> x.word), ' ')"))
        .withColumn("block1", without_spaces(F.col("name")))
        .withColumn("_initials", F.expr(long_words))
        .withColumn(
            "block2",
            F.expr(f"IF(size(_initials) >= {BLOCK_WORDS}, array_join(slice(_initials, 1, {BLOCK_WORDS}), ''), name)"),
        )
        .withColumn(
            "block3",
            F.expr(
                f"IF(length(name) >= {TAIL_LENGTH} AND size(w) >= {TAIL_WORDS}, "
                f"substring(reverse(name), 1, {TAIL_LENGTH}), name)"
            ),
        )
        .withColumn("freq_s", F.expr("array_join(transform(w, x -> string(x.count)), ' ')"))
        .withColumn("freq_b", F.expr("array_join(transform(w, x -> string(x.count_f)), ' ')"))
        .drop("w", "cutoff", "_ordered", "_initials")
    )


BLOCKS = ((2, "name2"), (3, "block1"), (4, "block2"), (5, "block3"))


def block_rows(features: DataFrame) -> DataFrame:
    """(pass, block, org_id, name, name3, marks, marks3) of the names that share a block with another name.

    Most blocks hold one name.  A hash per block and the number of the name tell which, so texts travel once a name and are written
    for the others alone; two blocks of one hash only let a row through that then finds no partner.
    """
    hashes = F.explode(F.array(*[F.struct(F.lit(n).alias("pass"), F.xxhash64(F.lit(n), c).alias("_h")) for n, c in BLOCKS]))
    slim = features.select("place", hashes.alias("b")).select("place", "b.*")
    crowded = slim.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_h")
    chosen = slim.join(crowded, "_h", "left_semi").groupBy("place").agg(F.collect_set("pass").alias("_passes"))
    blocks = F.explode(F.filter(
        F.array(*[F.struct(F.lit(n).alias("pass"), F.col(c).alias("block")) for n, c in BLOCKS]), lambda b: F.array_contains("_passes", b["pass"])))
    kept = ["org_id", "name", "name3", "marks", "marks3"]
    marked = features.join(chosen, "place").withColumns({"marks": letter_marks("name"), "marks3": letter_marks("name3")})
    return marked.select(*kept, blocks.alias("b")).select("b.*", *kept)


def close_names(features: DataFrame) -> DataFrame:
    """(pass, id_a, id_b) with id_a > id_b for passes 2 to 5 (shared block, similar names).

    Accepted are pairs with either score above 0.95 or both above 0.90: the first join
    finds every pair whose names score above 0.90, the second those whose ordered names
    score above 0.95, and between them they cover all three cases.
    """
    tasks = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut_lineage(block_rows(features).repartition(tasks))
    block = ["pass", "block"]
    left, right = (
        rows.select(*block, F.col("org_id").alias(f"id_{x}"), F.col("name").alias(f"n{x}"), F.col("name3").alias(f"o{x}"),
                    F.col("marks").alias(f"m{x}"), F.col("marks3").alias(f"p{x}")) for x in "ab")
    bigger = F.col("id_a") > F.col("id_b")
    # no score is needed where neither of the other cases can hold
    hopeful = may_exceed(CLOSE, "na", "nb", "ma", "mb") | may_exceed(BOTH_CLOSE, "oa", "ob", "pa", "pb")
    by_name = similar_pairs(
        left, right, block, "na", "nb", BOTH_CLOSE, bigger, one_table=True, written=True, marks=("ma", "mb"), promising=hopeful
    ).where((F.col("similarity") > CLOSE) | (jarow_batch("oa", "ob") > BOTH_CLOSE))
    by_order = similar_pairs(
        left.drop("na", "ma"), right.drop("nb", "mb"), block, "oa", "ob", CLOSE, bigger, one_table=True, written=True, marks=("pa", "pb"))
    return by_name.select("pass", "id_a", "id_b").union(by_order.select("pass", "id_a", "id_b")).distinct()


def same_order(features: DataFrame) -> DataFrame:
    """Pass 1: equal ordered names, each linked to the least id that has it."""
    linked = star_links(features.select("name3", "org_id"), ["name3"], "org_id")
    return linked.select(F.lit(1).alias("pass"), F.col("u").alias("id_a"), F.col("v").alias("id_b"))


def match_edges(features: DataFrame) -> DataFrame:
    return same_order(features).unionByName(close_names(features))


def clusters(features: DataFrame, edges: DataFrame) -> DataFrame:
    """(org_id, cluster_id): transitive merge, the smallest id wins."""
    return connected_components(features, edges, "org_id", "id_a", "id_b", "cluster_id")


def disambiguate(df: DataFrame, name: str, authority: str | None = None) -> DataFrame:
    """Every distinct name with its features and cluster id."""
    names = cut_lineage(name_table(df, name, authority))
    words = cut_lineage(word_table(names))
    features = cut_lineage(name_features(names, words, frequent_words(words)))
    return features.join(clusters(features, match_edges(features)), "org_id")


def merge_ids(df: DataFrame, column: str, groups: DataFrame) -> DataFrame:
    """Replace ids listed in ``groups`` (group, id) by the least id of their group."""
    full = groups.select("group", expand_id(F.col("id")).alias("id"))
    least = full.groupBy("group").agg(F.min("id").alias("to"))
    return update_join(df, full.join(least, "group"), {column: "id"}, {column: "to"}, ["to"])


def write_back(facts: DataFrame, name: str, clustered: DataFrame, column: str) -> DataFrame:
    """Cluster ids onto a fact table by name, '' where the name is unknown."""
    return map_values(facts, name, clustered, "name", "cluster_id", column)


def display_names(df: DataFrame, column: str, clustered: DataFrame, out: str = "org_name") -> DataFrame:
    """The most frequent name of each cluster id."""
    best = clustered.groupBy("cluster_id").agg(F.max_by("name", F.struct("cnt", "name")).alias("label"))
    return map_values(df, column, best, "cluster_id", "label", out)


def top_clusters(clustered: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` clusters with most names, with all their names."""
    top = (
        clustered.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_names"))
        .orderBy(F.desc("n_names"), "cluster_id").limit(n)
    )
    return clustered.select("cluster_id", "name", "cnt").join(top, "cluster_id")


def find_clusters(clustered: DataFrame, key: str) -> DataFrame:
    """Clusters with a name containing ``key``: how many such names and how frequent."""
    return find_text(clustered, "name", key).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n_names"), F.sum("cnt").alias("cnt")
    )


def members_of(clustered: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Names of the given cluster ids, short forms allowed."""
    return clustered.where(F.col("cluster_id").isin([i if len(i) > 12 else f"{i[0]}{int(i[1:]):012d}" for i in ids]))
