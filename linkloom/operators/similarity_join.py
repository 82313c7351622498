"""Blocked fuzzy joins that score few of a block's pairs and write none of the others.

A pair above the threshold must share a computable number of letters (see
``least_common_letters``).  A text's letters are kept as marks: a bit for its first A, one
for its second, and so on, so what two texts share is counted by the bits that both have set,
whatever the texts' length.  Rows carry their marks, some 70 bytes, and each test is made inside the join.

Short texts of large blocks meet by tokens: A1 stands for the first A, A2 for the second, and two
texts can only match if their rarest few tokens share one, so the equi join is on (block, token) and
a pair is kept only at the first token it shares.  A long text's rarest tokens hold
common letters, which meet nearly everywhere, so pairs with a long text, and blocks of a few rows, meet by
block alone.  Every step is a necessary condition: the result equals that of comparing the whole block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.similarity import MARK_NUMBERS, common_letters_bound, jarow_batch, least_common_letters, letter_marks
from linkloom.operators.skew import chunked_equi_join
from linkloom.session import cut_lineage, reachable

# Any fixed order is exact; listing rare letters first keeps the token groups small.
_RARE_FIRST = "QZXJ9876543210KVWYPBFGCMULDHSNRTOAIE "
# blocks of up to this many pairs are compared without tokens
SMALL_BLOCK = 4096
# texts of more letters meet by block alone
LONG_TEXT = 24
_RANK_LETTERS = "".join(chr(0x4E00 + i) for i in range(len(_RARE_FIRST)))


def _tokenised(df: DataFrame, text: str, threshold: float, tag: str) -> DataFrame:
    """A row per token by which a text meets others; '' stands for meeting by block alone."""
    size = f"length({text})"
    least = least_common_letters(threshold, size)
    letters = F.filter(F.split(F.translate(F.col(text), _RARE_FIRST, _RANK_LETTERS), ""), lambda c: c != "")
    short = ~F.col("_small") & F.expr(f"{size} <= {LONG_TEXT}")
    # in sorted order a letter's occurrence number is its distance from its first place
    tokens = f"slice(transform(_letters, (c, i) -> concat(c, string(i + 2 - array_position(_letters, c)))), 1, {size} - {least} + 1)"
    # a long text's partners have at least as many letters as it must share with them
    whole = f"IF(_small OR {size} >= {least_common_letters(threshold, str(LONG_TEXT + 1))}, array(''), array())"
    return (
        df.withColumn("_letters", F.when(short, F.sort_array(letters)))
        .withColumn(f"_p{tag}", F.expr(f"concat(coalesce({tokens}, array()), {whole})"))
        .drop("_letters")
        # the outer form keeps the optimizer from adding a size test that builds the tokens twice
        .withColumn("_token", F.explode_outer(f"_p{tag}"))
        .where(F.col("_token").isNotNull())
        .withColumn(f"_p{tag}", F.when(F.col("_token") != "", F.col(f"_p{tag}")))
        .withColumnRenamed("_small", f"_small{tag}")
    )


def _shared_blocks(left: DataFrame, right: DataFrame, block: Sequence[str], one_table: bool) -> DataFrame:
    """Blocks that can hold a pair; ``_small`` ones are cheaper to compare outright."""
    counts = left.groupBy(*block).agg(F.count(F.lit(1)).alias("_nl"))
    if one_table:
        counts = counts.where(F.col("_nl") > 1).withColumn("_nr", F.col("_nl"))
    else:
        counts = counts.join(right.groupBy(*block).agg(F.count(F.lit(1)).alias("_nr")), list(block))
    return counts.select(*block, (F.col("_nl") * F.col("_nr") <= SMALL_BLOCK).alias("_small"))


def may_exceed(threshold: float, a: str, b: str, marks_a: str, marks_b: str) -> Column:
    """False only for pairs of texts that cannot score above ``threshold``; the marks are those of ``letter_marks``."""
    shared = common_letters_bound([f"{marks_a}[{i}]" for i in range(MARK_NUMBERS)], [f"{marks_b}[{i}]" for i in range(MARK_NUMBERS)])
    return F.expr(f"{shared} >= {least_common_letters(threshold, f'length({a})', f'length({b})', a, b)}")


def _holds(df: DataFrame, test: Column) -> DataFrame:
    """Rows that pass a test which is to stay behind the join: a join's condition is one piece of code, and a long one is not compiled."""
    passed = F.explode_outer(F.filter(F.array(test), lambda t: t))
    return df.withColumn("_holds", passed).where(F.col("_holds").isNotNull()).drop("_holds")


def similar_pairs(
    left: DataFrame,
    right: DataFrame,
    block: Sequence[str],
    left_text: str,
    right_text: str,
    threshold: float,
    pair_filter: Column | None = None,
    score_name: str = "similarity",
    one_table: bool = False,
    written: bool = False,
    marks: tuple[str, str] | None = None,
    promising: Column | None = None,
) -> DataFrame:
    """Pairs of rows in one block whose texts score above ``threshold``.

    ``left`` is the comparator's first argument.  Apart from the block columns the two
    sides must not share column names.  Blank texts and NULL blocks match nothing.
    ``one_table`` says that both sides are the same rows, so single-row blocks drop out; ``written`` that they
    are spread over the tasks and cheap to read again.  ``marks`` are the columns of the texts' ``letter_marks``, where these are at hand.
    Only ``promising`` pairs are scored, which is asked of those that share enough letters.
    """
    left, right = left.where(F.col(left_text) != ""), right.where(F.col(right_text) != "")
    if not written:
        # both inputs are read for the block sizes and for the join: write them once
        tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        left, right = cut_lineage(left.repartition(tasks)), cut_lineage(right.repartition(tasks))
    blocks = _shared_blocks(left, right, block, one_table)
    made = None if marks else [rows.withColumn(m, letter_marks(text)) for rows, text, m in ((left, left_text, "_al"), (right, right_text, "_ar"))]
    arrays = marks or ("_al", "_ar")
    sides = [
        _tokenised(rows.withColumns({f"_m{tag}{i}": F.col(m)[i] for i in range(MARK_NUMBERS)}).join(blocks, list(block)), text, threshold, tag)
        for rows, text, tag, m in zip(made or (left, right), (left_text, right_text), "lr", arrays, strict=True)
    ]
    need = least_common_letters(threshold, f"length({left_text})", f"length({right_text})")
    fits = F.expr(f"least(length({left_text}), length({right_text})) >= {need}")
    shared = common_letters_bound(*([f"_m{tag}{i}" for i in range(MARK_NUMBERS)] for tag in "lr"))
    first_shared = "get(array_intersect(_pl, _pr), 0) = l._token"
    # short texts of a large block have met by their tokens
    unmet = f"_smalll OR greatest(length({left_text}), length({right_text})) > {LONG_TEXT}"
    condition = F.expr(f"l._token <> '' OR {unmet}") & fits & F.expr(f"{shared} >= {need}") & F.expr(f"l._token = '' OR {first_shared}")
    if pair_filter is not None:
        condition = pair_filter & condition
    candidates = chunked_equi_join(
        *sides,
        [*block, "_token"],
        condition,
        F.struct(*[F.col(c) for c in left.columns]),
        F.struct(*[F.col(c) for c in right.columns]),
    ).drop("_token", "_pl", "_pr", "_smalll", "_smallr", *[f"_m{tag}{i}" for tag in "lr" for i in range(MARK_NUMBERS)])
    hopeful = may_exceed(threshold, left_text, right_text, *arrays)
    candidates = _holds(candidates, hopeful if promising is None else hopeful & promising).drop("_al", "_ar")
    # as a generator the costly score runs once, after the join and its cheap tests
    reachable(left.sparkSession)
    passing = F.filter(F.array(jarow_batch(left_text, right_text)), lambda s: s > threshold)
    return candidates.withColumn(score_name, F.explode_outer(passing)).where(F.col(score_name).isNotNull())
