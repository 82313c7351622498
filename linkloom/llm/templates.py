"""Line de-duplication by a fixed-depth template tree.

A line's path in the tree is its token count and its first tokens, tokens with a digit standing as
variables.  The lines of a leaf fall together where they have the same form, then where most of
their tokens agree with the leaf's commonest form; places that differ are variables.  A template
found in enough different texts is dropped from all of them but the first.  Long lines do not recur
by chance, so few texts are enough for them; near copies of a text count once there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.store import written
from linkloom.operators.components import connected_components
from linkloom.operators.normalize import compute_once

_VARIABLE = "<*>"
#: From the start of a token only, without going back.
_WITH_DIGIT = "(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D0-9]*+[0-9][^\\x20\\x09-\\x0D]*+"
_OTHER_SPACE = "[\\x09-\\x0D]"
_SALTS = 16
#: Lines of so many tokens and more are dropped from so many unrelated texts on.
LONG_LINES = ((8, 5), (20, 3), (50, 2))
#: Near copies share this per cent of their shingles, as in the pipeline's near de-duplication.
_WORDS, _PERCENT, _SKETCH = 5, 80, 256


def _normal(line: Column) -> Column:
    """A line's tokens with one space between them, those with a digit replaced by the variable mark."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, _WITH_DIGIT, _VARIABLE)).otherwise(line)
    plain = F.when(masked.rlike(_OTHER_SPACE), F.regexp_replace(masked, _OTHER_SPACE, " ")).otherwise(masked)
    return F.trim(F.when(plain.contains("  "), F.regexp_replace(plain, " {2,}", " ")).otherwise(plain))


def _tokens(line: Column) -> Column:
    """Tokens of a line, those with a digit replaced by the variable mark."""
    return F.filter(F.split(_normal(line), " "), lambda x: x != "")


def _salted(many: DataFrame, few: DataFrame, on: list[str], by: str) -> DataFrame:
    """Inner join in which the rows of a key of ``many`` are dealt to several places by the column ``by``."""
    dealt = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return many.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(_SALTS)).cast("int")).join(dealt, [*on, "_salt"]).drop("_salt")


def _lines(texts: DataFrame, keep: list[str]) -> DataFrame:
    """A row per line of ``_text`` with a token: ``keep``, line number, tokens in one text, how many."""
    rows = texts.select(*keep, F.posexplode(F.split("_text", "\n")).alias("_no", "_line"))
    # a projection makes each rule's text once, a generator would make it wherever it is named
    rows = compute_once(rows.withColumn("_line", _normal(F.col("_line"))), "_tok", F.col("_line")).drop("_line").where("_tok != ''")
    return rows.withColumn("_size", F.length("_tok") - F.length(F.replace(F.col("_tok"), F.lit(" "), F.lit(""))) + 1)


def _similarity(a: Column, b: Column) -> Column:
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    return same / F.size(a)


def _bound(size: Column, min_texts: int, long_lines: tuple) -> Column:
    """Texts that a template of ``size`` tokens needs."""
    least = F.lit(min_texts)
    for tokens, n in sorted(long_lines):
        least = F.when(size >= tokens, min(n, min_texts)).otherwise(least)
    return least


def _near_copies(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(_digest, _group) of the texts of ``pairs`` (a, b) that are near copies of another, over any number of links.

    A text's sketch is the least hashes of its shingles: exact up to ``_SKETCH`` shingles, beyond it an
    estimate with a standard error of 2.5 per cent.
    """
    involved = pairs.select(F.explode(F.array("a", "b")).alias("_digest")).distinct()
    wanted = texts.select("_digest", "_text").join(involved.hint("merge"), "_digest", "left_semi").dropDuplicates(["_digest"])
    spaced = F.replace(F.lower("_text"), F.lit("\n"), F.lit(" "))
    spaced = F.when(spaced.rlike(_OTHER_SPACE), F.regexp_replace(spaced, _OTHER_SPACE, " ")).otherwise(spaced)
    words = compute_once(wanted, "_all", F.split(spaced, " ")).drop("_text")
    words = compute_once(words, "_w", F.transform(F.array_remove("_all", ""), lambda x: F.xxhash64(x))).drop("_all")
    grams = F.transform(F.sequence(F.lit(0), F.greatest(F.size("_w") - _WORDS, F.lit(0))), lambda i: F.xxhash64(*(F.get("_w", i + k) for k in range(_WORDS))))
    sketches = written(words.select("_digest", F.slice(F.sort_array(F.array_distinct(grams)), 1, _SKETCH).alias("_s")), "sketches")
    ends = [sketches.select(F.col("_digest").alias(c), F.col("_s").alias(f"_{c}")) for c in "ab"]
    both = pairs.join(ends[0].hint("merge"), "a").join(ends[1].hint("merge"), "b")
    both = compute_once(both, "_u", F.slice(F.sort_array(F.array_union("_a", "_b")), 1, _SKETCH))
    shared = F.size(F.array_intersect(F.array_intersect("_u", "_a"), F.col("_b")))
    links = written(both.where(100 * shared >= _PERCENT * F.size("_u")).select("a", "b"), "near-copies")
    nodes = links.select(F.explode(F.array("a", "b")).alias("_digest"))
    return written(connected_components(nodes, links, "_digest", "a", "b", "_group"), "near-groups")


def _open(forms: DataFrame, similarity: float, depth: int, least: Column) -> DataFrame:
    """The forms that may still be like another of their leaf, in leaves that enough texts reach.

    Of one band more than places that may differ, two like forms have one in common.
    """
    sized = compute_once(forms, "_size", F.size("_tok"))
    differ = F.floor(F.col("_size") * (1 - similarity) + 1e-6).cast("int")
    sized = compute_once(sized.where(differ > 0), "_bands", differ + 1)
    free = F.col("_size") - depth

    def edge(j: Column) -> Column:
        return F.floor(j * free / F.col("_bands")).cast("int")

    bands = F.transform(F.sequence(F.lit(0), F.col("_bands") - 1), lambda j: F.xxhash64(j, F.slice("_tok", edge(j) + depth + 1, edge(j + 1) - edge(j))))
    banded = sized.where(free > 0).select("_leaf", "_form", F.explode(bands).alias("_band"))
    shared = banded.groupBy("_leaf", "_band").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_leaf", "_band")
    alike = banded.join(shared.hint("merge"), ["_leaf", "_band"], "left_semi").select("_leaf", "_form").distinct()
    kept = sized.join(alike.hint("merge"), ["_leaf", "_form"], "left_semi")
    enough = kept.groupBy("_leaf").agg(F.sum("_texts").alias("_sum"), F.min("_size").alias("_size")).where(F.col("_sum") >= least).select("_leaf")
    return kept.join(enough.hint("merge"), "_leaf", "left_semi").drop("_size", "_bands")


def drop_recurring_lines(docs: DataFrame, min_texts: int = 10, min_tokens: int = 1, depth: int = 3, similarity: float = 0.8,
                         heads: int = 16, most_heads: int = 1024, id_col: str = "doc_id", text_col: str = "text",
                         long_lines: tuple[tuple[int, int], ...] = LONG_LINES) -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of ``text``, and n_lines, n_dropped.

    ``depth`` leading tokens and the token count choose a leaf.  The form that most texts
    of a leaf share becomes a template and takes in the leaf's forms with at least ``similarity`` equal
    tokens, then the next of those left, until no two forms left can be alike or be in enough texts;
    these are templates of their own.  The first round settles up to ``heads`` templates of every leaf, each further one
twice as many, up to ``most_heads``.  Lines under
    ``min_tokens`` tokens are never dropped, nor are lines of one or two tokens without a letter (numbers,
    brackets, rules).  A template in at least ``min_texts`` different texts
    is dropped, but from the text of the smallest document id that holds it; copies of a text
    count once and lose the same lines.

    ``long_lines`` holds (tokens, texts): templates of so many tokens are dropped from fewer texts
    on.  These texts must be unrelated: near copies (80 per cent of five-word shingles, over any
    number of links) count once, and near copies of the first text keep the line as it does.

    A null text stays null with 0 lines; an empty one has one empty line.  Rows with a null id take part,
    and come last in the order of ids.  Repeated rows stay.  An empty table gives no rows.  Other
    columns pass through; ones named n_lines or n_dropped are replaced.
    """
    digest = F.unhex(F.md5(F.coalesce(docs[text_col], F.lit("")).cast("binary")))
    texts = docs.select(docs[id_col].alias("_id"), digest.alias("_digest"), docs[text_col].alias("_text"))
    worded = (F.col("_size") > 2) | F.col("_tok").rlike("\\p{L}")
    lines = _lines(texts, ["_id", "_digest"]).where((F.col("_size") >= max(min_tokens, 1)) & worded)
    least = _bound(F.col("_size"), min_texts, long_lines)
    lines = written(lines.select(
        "_id", "_digest", "_no", "_size", F.xxhash64("_size", F.substring_index("_tok", " ", depth)).alias("_leaf"),
        F.unhex(F.md5(F.replace(F.col("_tok"), F.lit(" "), F.lit("\n")).cast("binary"))).alias("_form")), "lines")

    # one row per form and text, then per form; leaves that too few lines reach are left out
    busy = lines.groupBy("_leaf").agg(F.count(F.lit(1)).alias("_c"), F.min("_size").alias("_size")).where(F.col("_c") >= least).select("_leaf")
    # copies of a text have the same lines, so the least id and the least number belong together
    in_text = lines.groupBy("_leaf", "_form", "_digest").agg(F.min("_id").alias("_id"), F.min("_no").alias("_no"), F.min("_size").alias("_size"))
    order = F.struct(F.col("_id").isNull().alias("_late"), F.col("_id"), F.col("_digest"), F.col("_no"))
    forms = written(
        in_text.groupBy("_leaf", "_form").agg(F.count(F.lit(1)).alias("_texts"), F.min(order).alias("_first"), F.min("_size").alias("_size"))
        .join(busy, "_leaf", "left_semi"), "forms")

    # tokens of the forms that have company in their leaf, from each form's first text
    company = forms.groupBy("_leaf").agg(F.count(F.lit(1)).alias("_k"), F.sum("_texts").alias("_sum"), F.min("_size").alias("_size")).where(
        (F.col("_k") > 1) & (F.col("_sum") >= least)).select("_leaf")
    wanted = (
        forms.join(company, "_leaf", "left_semi")
        .select("_leaf", "_form", "_texts", F.col("_first._digest").alias("_digest"), F.col("_first._no").alias("_no"))
        .groupBy("_digest").agg(F.collect_list(F.struct("_no", "_leaf", "_form", "_texts")).alias("_want"))
    )
    sources = texts.select("_digest", "_text").where(F.col("_text").isNotNull())
    # sort-merge at every size: the drop lists and wanted lines grow with the input, and hot texts are split
    found = sources.join(wanted.hint("merge"), "_digest").select(F.split("_text", "\n").alias("_all"), "_want")
    found = found.select("_all", F.explode("_want").alias("_w"))
    open_forms = written(
        found.select("_w._leaf", "_w._form", "_w._texts", _tokens(F.get("_all", F.col("_w._no"))).alias("_tok"))
        .groupBy("_leaf", "_form").agg(F.max("_texts").alias("_texts"), F.max("_tok").alias("_tok")), "open-forms")

    merged, step = open_forms.select("_leaf", "_form", F.col("_form").alias("_template")).where("false"), 0
    while True:
        open_forms = written(_open(open_forms, similarity, depth, least), f"open-{step}")
        if open_forms.isEmpty():
            break
        # the leaf's first forms in order of texts; those unlike all earlier ones are heads
        rank = F.row_number().over(Window.partitionBy("_leaf").orderBy(F.desc("_texts"), F.desc("_form")))
        first = open_forms.withColumn("_rank", rank).where(F.col("_rank") <= heads)
        first = first.groupBy("_leaf").agg(F.array_sort(F.collect_list(F.struct("_rank", "_form", "_tok"))).alias("_h"))
        chosen = F.aggregate("_h", F.slice("_h", 1, 0), lambda out, h: F.when(
            F.exists(out, lambda x: _similarity(h["_tok"], x["_tok"]) >= similarity), out).otherwise(F.concat(out, F.array(h))))
        scored = open_forms.join(first.select("_leaf", chosen.alias("_h")), "_leaf")
        near = F.filter("_h", lambda x: _similarity(F.col("_tok"), x["_tok"]) >= similarity)
        scored = written(scored.select("_leaf", "_form", "_texts", "_tok", F.get(near, F.lit(0))["_form"].alias("_template")), f"round-{step}")
        merged = merged.unionByName(scored.where("_template is not null").select("_leaf", "_form", "_template"))
        open_forms = scored.where("_template is null").drop("_template")
        step, heads = step + 1, min(2 * heads, most_heads)

    named = forms.join(merged, ["_leaf", "_form"], "left").withColumn("_template", F.coalesce("_template", "_form"))
    # a text counts once for a template: forms merged by the template are few, so texts are counted anew for those only
    grouped = named.groupBy("_leaf", "_template").agg(
        F.sum("_texts").alias("_sum"), F.count(F.lit(1)).alias("_k"), F.min("_first").alias("_first"), F.min("_size").alias("_size")).where(F.col("_sum") >= least)
    candidates = written(named.select("_leaf", "_form", "_template").join(grouped, ["_leaf", "_template"]), "candidates")
    several = (
        _salted(lines.select("_leaf", "_form", "_digest"), candidates.where("_k > 1").select("_leaf", "_form", "_template"), ["_leaf", "_form"], "_digest")
        .select("_leaf", "_template", "_digest").distinct()
        .groupBy("_leaf", "_template").agg(F.count(F.lit(1)).alias("_n"))
    )
    counted = written(
        candidates.where("_k = 1").withColumn("_n", F.col("_sum"))
        .unionByName(candidates.where("_k > 1").join(several, ["_leaf", "_template"])).where(F.col("_n") >= least)
        .select("_leaf", "_form", "_template", "_first", "_n", least.alias("_least")), "counted")
    recurring = counted.where(F.col("_n") >= min_texts).select("_leaf", "_form", "_first")

    # under min_texts texts: at most min_texts - 1 a template, which are compared with each other
    few = written(
        lines.select("_leaf", "_form", "_digest").join(counted.where(F.col("_n") < min_texts), ["_leaf", "_form"])
        .select("_leaf", "_form", "_template", "_digest", F.col("_first._digest").alias("_one"), "_least").distinct(), "few-texts")
    met = few.groupBy("_leaf", "_template").agg(F.collect_set("_digest").alias("_d")).select(F.explode("_d").alias("a"), "_d")
    pairs = written(met.select("a", F.explode("_d").alias("b")).where("a < b").distinct(), "text-pairs")
    groups = _near_copies(texts, pairs)
    for c in ("_digest", "_one"):
        label = groups.select(F.col("_digest").alias(c), F.col("_group").alias(f"_group{c}"))
        few = few.join(label.hint("merge"), c, "left").withColumn(f"_group{c}", F.coalesce(f"_group{c}", c))
    unrelated = few.groupBy("_leaf", "_template").agg(F.countDistinct("_group_digest").alias("_n"), F.min("_least").alias("_least")).where(
        "_n >= _least").select("_leaf", "_template")
    doomed = few.where("_group_digest != _group_one").join(unrelated, ["_leaf", "_template"], "left_semi").select("_leaf", "_form", "_digest")

    gone = _salted(lines, recurring, ["_leaf", "_form"], "_digest").where(F.col("_digest") != F.col("_first._digest")).select("_digest", "_no")
    gone = gone.unionByName(lines.join(doomed, ["_leaf", "_form", "_digest"]).select("_digest", "_no"))
    dropped = gone.groupBy(F.col("_digest").alias("_llm_digest")).agg(F.collect_set("_no").alias("_llm_drop"))
    own = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    rows = docs.select(*own, digest.alias("_llm_digest")).join(dropped.hint("merge"), "_llm_digest", "left")
    rows = compute_once(rows, "_llm_all", F.split(F.col(text_col), "\n"))
    rows = compute_once(rows, "_llm_gone", F.when(F.col("_llm_drop").isNotNull(), F.sort_array("_llm_drop")))
    left = F.filter("_llm_all", lambda x, i: ~F.array_contains("_llm_gone", i))
    text = F.when(F.col("_llm_gone").isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    return rows.select(
        *(text.alias(c) if c == text_col else F.col(c) for c in own),
        F.coalesce(F.size("_llm_all"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("_llm_gone").isNull(), 0).otherwise(F.size("_llm_gone")).cast("long").alias("n_dropped"))
