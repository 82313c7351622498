"""Geocoding: an ordered cascade of gazetteer rules over distinct places.

A place is resolved by the first rule that finds it.  Instead of running the rules one
after another over a shrinking table, all exact rules are one equi join of (rule, key,
region) rows, all fuzzy rules one blocked similarity join, and the first rule wins by a
minimum per place.  The fuzzy rules only see places that no earlier exact rule resolved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.places import normalise_city_stages, recode_country
from linkloom.functions.text import prefix, segment, separator_count, suffix, without_spaces
from linkloom.operators.normalize import compute_once
from linkloom.operators.similarity_join import similar_pairs
from linkloom.operators.update_join import update_join
from linkloom.operators.upsert import first_per_key, insert_or_replace

# Rule number, value written for an exact hit.
EXACT_VALUE = {1: 11, 2: 11, 5: 21, 6: 21, 7: 21, 8: 21, 11: 15, 13: 25, 14: 25, 15: 25, 17: 31}
# Rule number -> (offset added to the score, least score).
FUZZY_VALUE = {3: (0, 0.92), 4: (10, 0.90), 9: (20, 0.92), 10: (20, 0.90), 12: (14, 0.95), 16: (24, 0.95)}
SEGMENT_RULES = range(1, 11)
DOMESTIC = "US"
PREFIX_LETTERS, SUFFIX_LETTERS = 3, 4
PLACE_KEY = ["city", "state", "country", "zipcode"]


def place_counts(df: DataFrame, city: str, state: str, country: str, zipcode: str | None = None, compat: bool = True) -> DataFrame:
    """(cnt, city, state, country, zipcode) of cleaned places.

    Raw places are counted first, so the city rules run once per distinct raw value.
    """
    zip_col = F.lit("") if zipcode is None else F.col(zipcode)
    raw = (
        df.select(
            F.upper(city).alias("city_x"), F.upper(state).alias("state"), F.upper(country).alias("country_x"),
            zip_col.alias("zipcode"),
        )
        .where((F.col("city_x") != "") | (F.col("zipcode") != ""))
        .groupBy("city_x", "state", "country_x", "zipcode")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    for name, stage in normalise_city_stages("city_x", "country_x", compat):
        raw = compute_once(raw, name, stage)
    return (
        raw.withColumn("city", F.col("_clean_city"))
        .withColumn("country", recode_country(F.col("_base"), F.col("country_x")))
        .where(F.col("city") != "")
        .groupBy(*PLACE_KEY)
        .agg(F.sum("n").alias("cnt"))
    )


def correct_typos(places: DataFrame, typos: DataFrame) -> DataFrame:
    """Attach ncity, nstate, ncountry from a correction table, NULL where it has none."""
    fixes = first_per_key(typos.select("city", "state", "country", "ncity", "nstate", "ncountry"), ["city", "state", "country"], [])
    return places.join(fixes, ["city", "state", "country"], "left").withColumn("city3", prefix(F.col("city"), 3))


def build_places(assignee_places: DataFrame, inventor_places: DataFrame, typos: DataFrame) -> DataFrame:
    """All places; where both sources have one, the inventor row replaces the other."""
    both = assignee_places.withColumn("source", F.lit(0)).unionByName(inventor_places.withColumn("source", F.lit(1)))
    return correct_typos(insert_or_replace(both, PLACE_KEY, ["source"]).drop("source"), typos)


def zip_number(zipcode: Column) -> Column:
    """Leading digits of a zip code's first segment without leading zeros, so ``02139-4307`` is ``2139``; '' without digits."""
    return F.regexp_replace(F.regexp_extract(segment(zipcode, 0), "^([0-9]+)", 1), "^0+(?=[0-9])", "")


def domestic_gazetteer(df: DataFrame, city: str, state: str, lat: str, long: str, zipcode: str | None = None) -> DataFrame:
    """City table with its match keys: blanks removed, first three and last four letters."""
    name = F.upper(city)
    blank_free = without_spaces(name)
    return df.select(
        (F.lit(None).cast("string") if zipcode is None else F.col(zipcode).cast("string")).alias("zipcode"),
        F.col(lat).cast("double").alias("lat"),
        F.col(long).cast("double").alias("long"),
        name.alias("city"),
        blank_free.alias("blk_city"),
        prefix(blank_free, PREFIX_LETTERS).alias("city3"),
        suffix(blank_free, SUFFIX_LETTERS).alias("city4r"),
        F.upper(state).alias("state"),
    )


def _entries(usloc: DataFrame, gnsloc: DataFrame, block: str) -> DataFrame:
    """One row per rule and gazetteer entry: (rule, key, region, text, result columns)."""

    def entry(rule: int, key: Column, text: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), key.alias("key"), text.alias("gaz_text"))

    c = F.col
    blank = F.lit("")
    home = [entry(1, c("city"), blank), entry(2, c("blk_city"), blank), entry(3, c("city3"), c("blk_city")),
            entry(4, c("city4r"), c("blk_city")), entry(11, c("city"), blank), entry(12, c("city3"), c("blk_city")),
            entry(17, zip_number(c("zipcode")), blank)]
    sort_name = c("sort_name_ro")
    first, last = (
        (sort_name, sort_name) if block == "literal" else (prefix(sort_name, PREFIX_LETTERS), suffix(sort_name, SUFFIX_LETTERS))
    )
    abroad = [entry(5, c("full_name_ro"), blank), entry(6, c("full_name_nd_ro"), blank), entry(7, c("short_form"), blank),
              entry(8, sort_name, blank), entry(9, first, sort_name), entry(10, last, sort_name),
              entry(13, c("full_name_ro"), blank), entry(14, c("full_name_nd_ro"), blank), entry(15, sort_name, blank),
              entry(16, first, sort_name)]
    domestic = usloc.select(
        F.explode(F.array(*home)).alias("e"), c("state").alias("region"), c("city").alias("g_city"),
        c("state").alias("g_state"), F.lit(DOMESTIC).alias("g_country"), F.coalesce("zipcode", blank).alias("g_zipcode"),
        c("lat").alias("g_lat"), c("long").alias("g_long"),
    )
    foreign = gnsloc.select(
        F.explode(F.array(*abroad)).alias("e"), c("cc1").alias("region"), c("full_name_nd_ro").alias("g_city"),
        blank.alias("g_state"), c("cc1").alias("g_country"), blank.alias("g_zipcode"),
        c("lat").cast("double").alias("g_lat"), c("long").cast("double").alias("g_long"),
    )
    every = domestic.unionByName(foreign).select("e.*", *[x for x in domestic.columns if x != "e"])
    # the zip rule looks at the code alone
    return every.withColumn("region", F.when(F.col("rule") == 17, "").otherwise(F.col("region"))).where(
        F.col("key").isNotNull() & (F.col("key") != "")
    )


def _requests(places: DataFrame) -> DataFrame:
    """One row per place and applicable rule: (place key, turn, rule, key, region, text).

    ``turn`` orders the rules: those of segment -1, 0, 1, ... and then the late ones.
    """
    c = F.col
    depth = separator_count(c("city"))
    turns = places.withColumn("_i", F.explode(F.sequence(F.lit(-1), depth)))
    piece = F.when(c("_i") == -1, c("city")).otherwise(
        F.coalesce(F.get(F.split("city", r" *?[,|] *"), c("_i")), F.lit(""))
    )
    turns = turns.withColumn("_seg", piece).withColumn("_blk", without_spaces(c("_seg")))
    blank = F.lit("")

    def ask(rule: int, key: Column, text: Column = blank) -> Column:
        return F.struct(F.lit(rule).alias("rule"), key.alias("key"), text.alias("place_text"))

    first, last = prefix(c("_blk"), PREFIX_LETTERS), suffix(c("_blk"), SUFFIX_LETTERS)
    early_home = F.array(ask(1, c("_seg")), ask(2, c("_blk")), ask(3, first, c("_blk")), ask(4, last, c("_blk")))
    early_abroad = F.array(
        ask(5, c("_seg")), ask(6, c("_seg")), ask(7, c("_seg")), ask(8, c("_blk")), ask(9, first, c("_blk")), ask(10, last, c("_blk"))
    )
    rules = F.when(c("country") == DOMESTIC, F.concat(early_home, early_abroad)).otherwise(early_abroad)
    early = turns.withColumn("a", F.explode(rules)).select(
        *PLACE_KEY, ((c("_i") + 1) * len(SEGMENT_RULES) + c("a.rule")).cast("long").alias("turn"), "a.*",
        F.when(c("a.rule") <= 4, c("state")).otherwise(c("country")).alias("region"),
    )
    nblk = without_spaces(c("ncity"))
    nfirst = prefix(nblk, PREFIX_LETTERS)
    late_rules = F.array(
        ask(11, c("ncity")), ask(12, nfirst, nblk), ask(13, c("ncity")), ask(14, c("ncity")), ask(15, nblk), ask(16, nfirst, nblk)
    )
    far = F.lit(1 << 40)
    late = (
        places.where(c("ncity").isNotNull()).withColumn("a", F.explode(late_rules))
        .where(~c("a.rule").isin(11, 12) | (c("ncountry") == DOMESTIC))
        .select(*PLACE_KEY, (far + c("a.rule")).alias("turn"), "a.*",
                F.when(c("a.rule") <= 12, c("nstate")).otherwise(c("ncountry")).alias("region"))
    )
    by_zip = places.where(c("country") == DOMESTIC).select(
        *PLACE_KEY, (far + 17).alias("turn"), F.lit(17).alias("rule"), zip_number(c("zipcode")).alias("key"),
        blank.alias("place_text"), blank.alias("region"),
    )
    return early.unionByName(late).unionByName(by_zip).where(c("key") != "")


RESULT = ["g_city", "g_state", "g_country", "g_zipcode", "g_lat", "g_long"]


def _value(rule: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in EXACT_VALUE.items() for x in pair])
    return table[rule].cast("double")


def candidates(places: DataFrame, usloc: DataFrame, gnsloc: DataFrame, block: str = "literal") -> DataFrame:
    """(place key, turn, rule, val, result columns): every rule's hits up to the first exact one."""
    requests = _requests(places)
    entries = _entries(usloc, gnsloc, block)
    fuzzy = list(FUZZY_VALUE)
    exact = (
        requests.where(~F.col("rule").isin(fuzzy)).drop("place_text")
        .join(entries.where(~F.col("rule").isin(fuzzy)).drop("gaz_text"), ["rule", "key", "region"])
        .select(*PLACE_KEY, "turn", "rule", _value(F.col("rule")).alias("val"), *RESULT)
    )
    resolved = exact.groupBy(*PLACE_KEY).agg(F.min("turn").alias("_exact_turn"))
    open_requests = (
        requests.where(F.col("rule").isin(fuzzy))
        .join(resolved, PLACE_KEY, "left")
        .where(F.col("_exact_turn").isNull() | (F.col("turn") < F.col("_exact_turn")))
        .drop("_exact_turn")
    )
    # compare distinct texts; places and entries that share one come back afterwards
    texts = open_requests.select("rule", "key", "region", "place_text").distinct()
    names = entries.where(F.col("rule").isin(fuzzy)).select("rule", "key", "region", "gaz_text").distinct()
    least = min(limit for _, limit in FUZZY_VALUE.values())
    limits = F.create_map(*[F.lit(x) for r, (_, limit) in FUZZY_VALUE.items() for x in (r, limit)])
    offsets = F.create_map(*[F.lit(x) for r, (add, _) in FUZZY_VALUE.items() for x in (r, float(add))])
    near = similar_pairs(texts, names, ["rule", "key", "region"], "place_text", "gaz_text", least)
    near = near.where(F.col("similarity") > limits[F.col("rule")]).withColumn(
        "val", F.col("similarity") + offsets[F.col("rule")]
    )
    similar = (
        open_requests.join(near, ["rule", "key", "region", "place_text"])
        .join(entries, ["rule", "key", "region", "gaz_text"])
        .select(*PLACE_KEY, "turn", "rule", "val", *RESULT)
    )
    return exact.unionByName(similar)


def resolve_places(places: DataFrame, usloc: DataFrame, gnsloc: DataFrame, block: str = "literal") -> DataFrame:
    """One row per resolved place: rule, value, number of candidates and the chosen entry.

    Among a rule's candidates the best value wins, then the entry's name and position.
    """
    found = candidates(places, usloc, gnsloc, block)
    best_first = F.struct(-F.col("val"), *[F.col(c) for c in RESULT])
    per_rule = found.groupBy(*PLACE_KEY, "turn", "rule").agg(
        F.count(F.lit(1)).alias("mtch"), F.min_by(F.struct("val", *RESULT), best_first).alias("best")
    )
    first = per_rule.groupBy(*PLACE_KEY).agg(F.min_by(F.struct("rule", "mtch", "best"), "turn").alias("f"))
    return first.select(
        *PLACE_KEY, F.col("f.rule").alias("rule"), F.col("f.mtch").alias("mtch"), "f.best.*"
    ).withColumn("city3", prefix(F.col("city"), 3))


def unresolved(places: DataFrame, resolved: DataFrame) -> DataFrame:
    return places.join(resolved.select(*PLACE_KEY), PLACE_KEY, "left_anti")


def progress(places: DataFrame, resolved: DataFrame) -> DataFrame:
    """Remaining, matched and total places."""
    matched = resolved.agg(F.count(F.lit(1))).scalar()
    total = places.agg(F.count(F.lit(1)).alias("total")).withColumn("matched", matched)
    return total.select((F.col("total") - F.col("matched")).alias("remaining"), "matched", "total")


def attach_places(df: DataFrame, resolved: DataFrame, city: str, state: str, country: str, zipcode: str | None = None) -> DataFrame:
    """Geocodes onto an entity table: the coarse key first, the key with zip code on top."""
    sets = {"ncity": "g_city", "nstate": "g_state", "ncountry": "g_country", "nzipcode": "g_zipcode", "nlat": "g_lat", "nlong": "g_long"}
    coarse = {city: "city", state: "state", country: "country"}
    order = ["zipcode", *RESULT]
    df = update_join(df, resolved, coarse, sets, order)
    if zipcode:
        df = update_join(df, resolved, {**coarse, zipcode: "zipcode"}, sets, order)
    return df
