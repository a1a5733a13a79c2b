"""Mixing sources to target weights by Efraimidis-Spirakis sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstar.llm.common import GAP, WORD
from snapstar.session import stored

WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2.0
SEED = "mix"
#: Parts that the range of a source is cut into each round, and parts of a source that meet its values on their own.
PARTS, SALTS = 4096, 32
#: The order of documents within a source: key, size, hash of the text.
ORDER = ("_key", "size", "_tie")
#: Characters that speak against running text.
SYMBOLS = "[#*$%&|<>{}=0-9]"


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: str, size: Column) -> Column:
    """The sampling weight of a document, above 0 up to 1: the fewer symbols and digits a word, the higher."""
    symbols = F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0))
    return 1.0 / (1.0 + symbols.cast("double") / F.greatest(size, F.lit(1)).cast("double"))


def targets(sums: DataFrame) -> DataFrame:
    """``sums`` (source, source_size), a row for each source, with ``target``.

    Sources weigh ``WEIGHTS`` in turn, by code point with null last, and share
    ``SHARE`` times all sizes. Filling up sources in the order of limit by weight,
    the level that holds for all of them is the highest one found on the way: it
    rises as long as a source stays below it, and falls or stays after that.
    """
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("_place") % len(WEIGHTS) + 1).cast("int"))
    ranked = sums.withColumn("_place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    ranked = ranked.withColumn("_weight", weight)
    order = [F.col("source_size").cast("double") / F.col("_weight"), F.col("_place")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    level = (F.lit(SHARE) * F.sum("source_size").over(every) - LIMIT * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum(
        "_weight"
    ).over(rest)
    filled = ranked.withColumn("_level", level).withColumn("_level", F.max("_level").over(every))
    target = F.least(F.col("_level") * F.col("_weight"), F.lit(LIMIT) * F.col("source_size"))
    return filled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, seed: str = SEED, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with size, source_size, target, epochs, part and taken = epochs * size + part.

    A source first takes all its documents as often as its target holds it whole.
    The rest goes to documents by the key -ln(u) / quality, where u comes from
    the id and ``seed``, in ascending order until the words are used up; the one
    on the border gives as many words as fit. Reruns agree. Null or blank texts
    have size 0 and part 0; a null source is one source; null ids share one u;
    equal keys go by size, then by a hash of the text, and rows equal in all of
    these are interchangeable. Columns of the new names are replaced.

    Only the border of each source has to be found; its documents are not
    sorted. Sizes and keys are written once, and ``_borders`` adds them up by
    ever narrower parts of the key range. Then each document is compared with
    the border of its source, so that no text is shuffled where Spark broadcasts
    a row for each source, and no source gathers where it doesn't.
    """
    size = words(text)
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(id).cast("string")).cast("binary")), 1, 13), 16, 10)
    u = (u.cast("double") + 0.5) / float(1 << 52)
    new = ["size", "source_size", "target", "epochs", "part", "taken"]
    rows = docs.select(
        F.struct("*").alias("_row"),
        F.col(source).isNull().alias("_none"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_name"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("_salt"),
        size.alias("size"),
        (-F.log(u) / quality(text, size)).alias("_key"),
        F.shiftrightunsigned(F.xxhash64(text), 11).alias("_tie"),
    )
    keyed = stored(rows.drop("_row"), "mix-keys")
    bounds = [f(c).alias(f"{f.__name__}{c}") for c in ORDER for f in (F.min, F.max)]
    sums = stored(keyed.groupBy("_none", "_name").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"), *bounds), "mix-sums")
    named = F.when(~F.col("_none"), F.col("_name")).alias("source")
    goals = targets(sums.select(named, "source_size"))
    goals = goals.select(F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_name"), "target")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5).cast("long")
    sums = stored(sums.join(goals, ["_none", "_name"]).withColumn("epochs", epochs).withColumn("_left", rest), "mix-sums")
    borders = _borders(keyed, sums)
    found = _beside(rows, borders)
    below = F.lit(False)
    for c in reversed(ORDER):
        below = (F.col(c) < F.col(f"min{c}")) | ((F.col(c) == F.col(f"min{c}")) & below)
    on = F.lit(True)
    for c in ORDER:
        on = on & (F.col(c) == F.col(f"min{c}"))
    found = found.withColumn("_on", on & (F.col("_left") > 0)).withColumn("_below", below & (F.col("_left") > 0))
    if borders.filter("_n > 1 and _left > 0").isEmpty():
        found = found.withColumn("_number", F.lit(0).cast("long"))
    else:
        many = F.col("_on") & (F.col("_n") > 1)
        single = found.filter(~many).withColumn("_number", F.lit(0).cast("long"))
        found = single.unionByName(_numbered(found.filter(many)))
    own = F.greatest(F.lit(0), F.least("size", F.col("_left") - F.col("_number") * F.col("size")))
    part = F.when(F.col("_below"), F.col("size")).when(F.col("_on"), own).otherwise(F.lit(0)).cast("long")
    found = found.withColumn("part", part).withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
    return found.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in new], *new)


def _beside(rows: DataFrame, values: DataFrame) -> DataFrame:
    """Each row with the values of its source, which a source meets in ``SALTS`` parts, not as a whole."""
    salts = F.array(*[F.lit(i).cast("long") for i in range(SALTS)])
    return rows.join(values.withColumn("_salt", F.explode(salts)), ["_none", "_name", "_salt"])


def _borders(keyed: DataFrame, sums: DataFrame) -> DataFrame:
    """``sums`` with, for each source, the border: the least and greatest of each of ``ORDER`` are one value,
    ``_n`` rows have it, and ``_left`` words are for these. Sources that need no part keep ``_left`` below 1.

    The range of a source is cut into ``PARTS`` even parts, whose words are summed;
    the part where the words run out is the next range, from its least to its
    greatest value, so that a range of two values or more always gets narrower.
    Keys come first, then sizes among equal keys, then hashes of texts among
    equal sizes. A round is one aggregation with at most ``PARTS`` rows for each
    source.
    """
    group = ["_none", "_name"]
    fixed = [c for c in sums.columns if c not in ("_n", "_left") and c[:3] not in ("min", "max")]
    now = sums
    for column in ORDER:
        low, high = F.col(f"min{column}"), F.col(f"max{column}")
        while not now.filter((F.col("_left") > 0) & (low < high)).isEmpty():
            inside = _beside(keyed, now.filter("_left > 0").select(*group, "_left", *[f"{e}{c}" for c in ORDER for e in ("min", "max")]))
            for c in ORDER:
                inside = inside.filter(F.col(c).between(F.col(f"min{c}"), F.col(f"max{c}")))
            place = F.floor((F.col(column) - low) * (F.lit(float(PARTS)) / (high - low).cast("double")))
            place = F.when(low < high, F.least(place, F.lit(PARTS - 1))).otherwise(0).cast("int")
            bounds = [f(c).alias(f"{f.__name__}{c}") for c in ORDER for f in (F.min, F.max)]
            parts = inside.groupBy(*group, "_left", place.alias("_place")).agg(F.sum("size").alias("_sum"), F.count("*").alias("_n"), *bounds)
            until = F.sum("_sum").over(Window.partitionBy(*group).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0))
            parts = parts.withColumn("_until", until).filter("_until - _sum < _left and _left <= _until")
            parts = parts.withColumn("_left", F.col("_left") - F.col("_until") + F.col("_sum")).drop("_until", "_sum", "_place")
            narrowed = now.filter("_left > 0").select(*fixed).join(parts, group)
            now = stored(narrowed.unionByName(now.filter("_left <= 0")), "mix-borders")
    return now


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_number``, from 0 in each source. They are written with their task, tasks are counted, and each numbers its own."""
    rows = stored(rows.withColumn("_task", F.spark_partition_id()), "mix-ties")
    key = ["_none", "_name", "_task"]
    earlier = Window.partitionBy("_none", "_name").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*key).agg(F.count("*").alias("_count"))
    counts = counts.withColumn("_first", F.coalesce(F.sum("_count").over(earlier), F.lit(0))).drop("_count")
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0))) - 1
    return rows.withColumn("_at", place).join(counts, key).withColumn("_number", F.col("_first") + F.col("_at")).drop("_task", "_at", "_first")


def mixture(docs: DataFrame, text: str = "text", chars: str = "n_chars", **names: str) -> DataFrame:
    """The documents of the mix, in the columns of ``docs``: a row for each epoch, and one for a part.

    A part that isn't the whole document is its first words, joined by spaces, and
    has ``chars``, if there is such a column, set to its length. Null texts and
    texts without words count no words and come with whole epochs only; a null
    source is one source, and ties and repeated rows go as in ``mix``. An empty
    table gives no rows.
    """
    mixed = mix(docs.select("*", *[F.col(c).alias(f"_own_{c}") for c in docs.columns]), text=text, **names)
    copies = F.concat(
        F.array_repeat(F.lit(False), F.col("epochs").cast("int")), F.array_repeat(F.lit(True), F.when(F.col("part") > 0, 1).otherwise(0))
    )
    cut = F.col("_cut") & (F.col("part") < F.col("size"))
    first = F.array_join(F.slice(F.array_remove(F.split(f"_own_{text}", GAP), ""), 1, F.greatest(F.col("part"), F.lit(1)).cast("int")), " ")
    rows = mixed.withColumn("_cut", F.explode(copies)).withColumn("_first", F.when(cut, first).otherwise(F.col(f"_own_{text}")))
    given = {text: F.col("_first")}
    if chars in docs.columns:
        given[chars] = F.when(cut, F.length("_first")).otherwise(F.col(f"_own_{chars}")).cast(docs.schema[chars].dataType)
    return rows.select(*[given.get(c, F.col(f"_own_{c}")).alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


SQL = f"""
with sized as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
        coalesce(len(regexp_extract_all(text, '{SYMBOLS}')), 0)::double as symbols,
        (('0x' || substr(md5(concat_ws('|', '{SEED}', doc_id::varchar)), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 as u
    from documents),
sums as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (
    select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight,
        row_number() over (order by source nulls last) as place
    from sums),
levels as (
    select *, (1.5 * sum(source_size) over () - 2.0 * coalesce(sum(source_size) over (
            order by source_size::double / weight, place rows between unbounded preceding and 1 preceding), 0))::double
        / sum(weight) over (order by source_size::double / weight, place
            rows between current row and unbounded following)::double as level
    from ranked),
goals as (
    select source, source_size, least(max(level) over () * weight, 2.0 * source_size)::double as target from levels),
keyed as (
    select s.doc_id, s.size, g.source_size, g.target, s.source,
        case when g.source_size > 0 then floor(g.target / g.source_size) else 0 end::bigint as epochs,
        -ln(s.u) / (1.0::double / (1.0::double + s.symbols / greatest(s.size, 1)::double)) as k
    from sized s join goals g on s.source is not distinct from g.source),
summed as (
    select *, coalesce(sum(size) over (partition by source order by k, doc_id, size
        rows between unbounded preceding and 1 preceding), 0) as before
    from keyed)
select doc_id, size, source_size, target,
    (epochs * size + greatest(0, least(size, floor(target - epochs * source_size + 0.5) - before)))::bigint as taken
from summed
"""
