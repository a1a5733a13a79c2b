"""Personal data: labelers vote on spans, expectation-maximisation weighs them, a classifier decides. DataFrame functions only."""

from __future__ import annotations

import math
import operator
from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstar.llm.outliers import let
from snapstar.session import stored

#: The kinds in the order of reports, and the pattern of each. Possessive repeats and the condition
#: on the character before find what plain ones do, in linear time and without recursion.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "key": r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*+[0-9])(?=[0-9_]*+[A-Za-z])[A-Za-z0-9_]{16,}+",
}
BASE = ("email", "ip", "card", "phone")
#: What a text must contain for a kind to be looked for, where that is simpler than its pattern.
TRIGGERS = {"email": "@", "ip": "[0-9][.][0-9]", "card": "[0-9][\x20-]?[0-9]", "phone": "[+][0-9]"}

#: Gazetteers.
FIRST_NAMES = """
Alice Anna Antoine Camille Carlos Carmen Charles Claire David Elena Emily Emma Ernst François Franz Friedrich Hans
Heinrich Hélène Isabel James Jean Jennifer John José Juan Jürgen Karl Klaus Laura Linda Louis Lucía Luis Maria María
Marie Mary Michael Miguel Nicolas Patricia Pedro Peter Philippe Pierre Robert Sarah Sophie Susan Thomas Ursula William
""".split()
TITLES = "Mr Mrs Ms Dr Herr Frau Monsieur Madame Señor Señora".split()
PATTERNS["name"] = rf"(?<!\p{{L}})(?=[A-Z])(?:{'|'.join([*FIRST_NAMES, *TITLES])})\.?\x20\p{{Lu}}\p{{Ll}}+"
DOMAINS = "biz com de dev edu es eu fr gov info io it net nl org ch at be uk us ca au".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 61 81 82 86 90 91".split()
RESERVED_IP = r"^0*(0|10|127|2(2[4-9]|[3-5][0-9]))\."
CARD_STARTS = "^(4|5[1-5]|2[2-7]|3[47]|6)"
SECRET = "^((AKIA|ASIA)[0-9A-Z]{16}|(sk|pk|rk)_[A-Za-z0-9_]{16,}|gh[pousr]_[A-Za-z0-9]{20,}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"

#: What stands before a span of a kind, or of anything else that looks like it.
CUES = {
    "email": "(e-?mail|contact|write to|mailto|correo|courriel)[^a-z]*$",
    "ip": r"(\bip|address|host|server|adresse|dirección)[^a-z]*$",
    "card": "(card|visa|mastercard|credit|iban|karte|carte|tarjeta)[^a-z]*$",
    "phone": "(phone|call|tel|fax|mobile|whatsapp|telefon|téléphone|teléfono)[^a-z]*$",
    "key": "(key|token|secret|passw(or)?d|pwd|auth|bearer|credential)[^a-z0-9]*$",
    "name": "(dear|regards|sincerely|name|by|from|contact)[^a-z]*$",
}
COUNTER_CUES = r"(version|release|v\.?|section|chapter|figure|table|isbn|doi|commit|sha|md5|checksum|build)[^a-z]*$"
CONTEXT = 32

VOTERS = ("regex", "gazetteer", "context", "shape")
FEATURES = ("kind", *VOTERS, "size", "digits", "left", "right")
ROUNDS = 60


def running(values: Column, add: Callable[[Column, Column], Column] = operator.add) -> Column:
    """The running sums of an array of longs: block by block, so that long arrays don't cost the square of their size.

    ``add`` may be any operation whose order of brackets doesn't matter.
    """
    block = 256

    def sums(part: Column) -> Column:
        first = F.array(F.element_at(part, 1))
        return F.aggregate(F.slice(part, 2, block), first, lambda a, x: F.concat(a, F.array(add(F.element_at(a, -1), x))))

    def joined(parts: Column) -> Column:
        bases = sums_of_blocks(F.transform(parts, lambda p: F.element_at(p, -1)))
        return let(
            bases,
            lambda b: F.flatten(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.transform(p, lambda x: add(F.get(b, i - 1), x))))),
        )

    def sums_of_blocks(lasts: Column) -> Column:
        return F.aggregate(
            F.slice(lasts, 2, F.size(lasts)),
            F.array(F.element_at(lasts, 1)),
            lambda a, x: F.concat(a, F.array(add(F.element_at(a, -1), x))),
        )

    def whole(own: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(own) - 1) / block).cast("int"))
        parts = F.transform(blocks, lambda i: sums(F.slice(own, i * block + 1, block)))
        return F.when(F.size(own) > 0, let(parts, joined)).otherwise(F.array().cast("array<long>"))

    return let(values, whole)


def matches(text: Column, kind: str) -> Column:
    """The leftmost non-overlapping matches of a kind, as (kind, start, end, hit, before, after) in code points.

    ``before`` are the ``CONTEXT`` characters that precede it and ``after`` is the next
    one. Both come from the pieces of the text between the matches: to go to each
    place from the start of the text would cost the square of its length.
    """
    pattern = PATTERNS[kind]

    def spans(hits: Column) -> Column:
        return let(F.split(text, pattern, -1), lambda gaps: placed(hits, gaps))

    def placed(hits: Column, gaps: Column) -> Column:
        steps = F.transform(hits, lambda hit, i: (F.length(F.get(gaps, i)) + F.length(hit)).cast("long"))

        def tail(piece: Column) -> Column:
            return F.right(piece, F.lit(CONTEXT))

        # What precedes a match: the match before it, and the gap between them. With the gap they have three characters
        # or more, so that this many of them hold the context.
        pieces = F.transform(gaps, lambda gap, i: F.concat(F.when(i > 0, tail(F.get(hits, i - 1))).otherwise(""), tail(gap)))
        many = CONTEXT // 3 + 1

        def row(hit: Column, i: Column, ends: Column, own: Column) -> Column:
            first = F.greatest(i - many + 1, F.lit(0))
            before = tail(F.array_join(F.slice(own, first + 1, i - first + 1), ""))
            after = F.left(F.concat(F.left(F.get(gaps, i + 1), F.lit(1)), F.coalesce(F.left(F.get(hits, i + 1), F.lit(1)), F.lit(""))), F.lit(1))
            return F.struct(
                F.lit(kind).alias("kind"),
                (F.get(ends, i) - F.length(hit)).alias("start"),
                F.get(ends, i).alias("end"),
                hit.alias("hit"),
                before.alias("before"),
                after.alias("after"),
            )

        return let(running(steps), lambda ends: let(pieces, lambda own: F.transform(hits, lambda hit, i: row(hit, i, ends, own))))

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,hit:string,before:string,after:string>>")
    wanted = text.rlike(TRIGGERS.get(kind, pattern))
    return F.when(wanted, found).otherwise(empty)


def valid(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(kind in BASE)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(kind: str, hit: Column, base: Column, before: Column) -> dict[str, Column]:
    never = F.lit(False)
    regex = {
        "key": _vote(hit.rlike(SECRET), ~(hit.rlike("[0-9]") & hit.rlike("[A-Za-z]"))),
        "name": _vote(hit.rlike(rf"^({'|'.join(TITLES)})[.\x20]"), never),
    }.get(kind, _vote(base, ~base))
    listed = {
        "email": hit.rlike(rf"(?i)\.({'|'.join(DOMAINS)})$"),
        "ip": ~hit.rlike(RESERVED_IP),
        "card": hit.rlike(CARD_STARTS),
        "phone": hit.rlike(rf"^\+({'|'.join(CALLING_CODES)})"),
        "name": hit.rlike(rf"^({'|'.join(FIRST_NAMES)})\x20"),
    }
    variety = F.size(F.array_distinct(F.split(F.regexp_replace(hit, "[^A-Za-z0-9]", ""), "")))
    return {
        "regex": regex,
        "gazetteer": _vote(listed[kind], ~listed[kind]) if kind in listed else F.lit(0),
        "context": _vote(before.rlike(CUES[kind]), before.rlike(COUNTER_CUES)),
        "shape": _vote(variety >= 6, variety <= 3),
    }


def _labelled(text: Column, kind: str) -> Column:
    """The candidates of a kind with the labelers' votes and the classifier's features."""

    def row(x: Column) -> Column:
        def seen(before: Column) -> Column:
            base = valid(kind, x["hit"])
            share = F.length(F.regexp_replace(x["hit"], "[^0-9]", "")) / F.length(x["hit"])
            return F.struct(
                x["kind"].alias("kind"),
                x["start"].alias("start"),
                x["end"].alias("end"),
                base.alias("base"),
                *[v.cast("int").alias(n) for n, v in _votes(kind, x["hit"], base, before).items()],
                F.least(F.floor(F.length(x["hit"]) / 8), F.lit(4)).cast("int").alias("size"),
                F.floor(share * 3).cast("int").alias("digits"),
                _side(F.substring(before, -1, 1)).alias("left"),
                _side(x["after"]).alias("right"),
            )

        return let(F.lower(x["before"]), seen)

    return F.transform(matches(text, kind), row)


def _side(char: Column) -> Column:
    return F.when(char.rlike(r"^[\x20\x09-\x0D]?$"), 0).when(char.rlike(r"^[\p{L}\p{N}]$"), 2).otherwise(1)


def candidates(docs: DataFrame, name: str = "candidates", text: str = "text") -> DataFrame:
    """``docs`` with an array of all candidates: matches of each kind, those that fail its checks included.

    Keys and names that overlap a valid match of a base kind are left out.
    """
    own = f"_{name}_text"
    found = docs.withColumn(own, F.coalesce(text, F.lit("")))
    for kind in PATTERNS:
        found = found.withColumn(f"_{name}_{kind}", _labelled(F.col(own), kind))
    base = F.filter(F.concat(*[F.col(f"_{name}_{k}") for k in BASE]), lambda x: x["base"])
    other = F.concat(F.col(f"_{name}_key"), F.col(f"_{name}_name"))
    every = F.concat(*[F.col(f"_{name}_{k}") for k in BASE], F.when(F.size(other) > 0, _free(base, other)).otherwise(other))
    return found.withColumn(name, every).drop(own, *[f"_{name}_{k}" for k in PATTERNS])


def _free(base: Column, other: Column) -> Column:
    """The ``other`` spans that overlap no ``base`` one: by kind, then place.

    Both are put in one order, a base span where it starts, another where it ends.
    Of the base spans before it in that order, which start before it ends, the one
    that ends last tells whether any overlaps it.
    """
    none = F.when(F.lit(False), F.get(other, F.lit(0)))  # a null of the right type
    starts = F.transform(base, lambda x: F.struct(x["start"].alias("at"), F.lit(1).alias("side"), x["end"].alias("top"), none.alias("x")))
    ends = F.transform(
        other, lambda x: F.struct(x["end"].alias("at"), F.lit(0).alias("side"), F.lit(-1).cast("long").alias("top"), x.alias("x"))
    )

    def alone(order: Column) -> Column:
        tops = running(F.transform(order, lambda m: m["top"]), F.greatest)
        return let(tops, lambda t: F.filter(order, lambda m, i: (m["side"] == 0) & (F.get(t, i) <= m["x"]["start"])))

    def of(found: Column, kind: str) -> Column:
        return F.transform(F.filter(found, lambda m: m["x"]["kind"] == kind), lambda m: m["x"])

    def by_kind(found: Column) -> Column:
        return F.concat(of(found, "key"), of(found, "name"))

    return let(let(F.sort_array(F.concat(starts, ends)), alone), by_kind)


class Model:
    """Weights of the final span classifier, by feature and value."""

    def __init__(self, rows: list[tuple[dict, int]]):
        """``rows``: each combination of features with its count; there are only so many combinations."""
        self.weights: dict[tuple[str, object], float] = {}
        if rows:
            self._train(rows, reliabilities(rows))

    def _train(self, rows: list[tuple[dict, int]], truth: list[float]) -> None:
        """Logistic regression on the labelers' consensus; large counts weigh by their logarithm."""
        keys = [[(f, row[f]) for f in FEATURES] for row, _ in rows]
        heavy = [1 + math.log(n) for _, n in rows]
        total = sum(heavy)
        self.weights = {k: 0.0 for ks in keys for k in ks}
        for _ in range(300):
            slope = dict.fromkeys(self.weights, 0.0)
            for ks, w, y in zip(keys, heavy, truth, strict=True):
                miss = w * (y - 1 / (1 + math.exp(-max(-30, min(30, sum(self.weights[k] for k in ks))))))
                for k in ks:
                    slope[k] += miss
            for k, s in slope.items():
                self.weights[k] += 2 * (s / total - 0.0005 * self.weights[k])

    def accepts(self, x: Column) -> Column:
        """Base spans stay; others are taken from a chance of one half on."""
        score = F.lit(0.0)
        for f in FEATURES:
            values = sorted((v, w) for (name, v), w in self.weights.items() if name == f)
            if values:
                table = F.create_map(*[F.lit(item) for pair in values for item in pair])
                score = score + F.coalesce(F.element_at(table, x[f]), F.lit(0.0))
        return x["base"] | (score > 0)


def reliabilities(rows: list[tuple[dict, int]]) -> list[float]:
    """The chance of each combination to be personal data: two classes, labelers independent within a class.

    Expectation-maximisation over counts: how often each labeler gives each vote
    in a class, and how frequent the class is among the candidates of a kind.
    """
    truth = [1 / (1 + math.exp(-1.5 * sum(row[v] for v in VOTERS))) for row, _ in rows]
    for _ in range(ROUNDS):
        share, votes = {}, {}
        for kind in {row["kind"] for row, _ in rows}:
            own = [(n, t) for (row, n), t in zip(rows, truth, strict=True) if row["kind"] == kind]
            share[kind] = (1 + sum(n * t for n, t in own)) / (2 + sum(n for n, _ in own))
        for voter, value, side in product(VOTERS, (-1, 0, 1), (0, 1)):
            part = [(n * (t if side else 1 - t), row[voter]) for (row, n), t in zip(rows, truth, strict=True)]
            votes[voter, value, side] = (1 + sum(n for n, v in part if v == value)) / (3 + sum(n for n, _ in part))
        truth = []
        for row, _ in rows:
            odds = math.log(share[row["kind"]] / (1 - share[row["kind"]]))
            odds += sum(math.log(votes[v, row[v], 1] / votes[v, row[v], 0]) for v in VOTERS)
            truth.append(1 / (1 + math.exp(-max(-30, min(30, odds)))))
    return truth


def fit(found: DataFrame, name: str = "candidates") -> Model:
    """A model of all candidates: what is collected are counts of combinations of a few small features."""
    each = found.select(F.explode(name).alias("x")).groupBy(*[F.col(f"x.{f}").alias(f) for f in FEATURES]).count()
    rows = [(r.asDict(), r["count"]) for r in each.collect()]
    return Model(sorted(rows, key=lambda r: tuple(r[0][f] for f in FEATURES)))


def accepted(model: Model, name: str = "candidates") -> Column:
    """The spans that count, (kind, start, end, base), by kind and then start."""
    kept = F.filter(name, model.accepts)
    return F.transform(kept, lambda x: F.struct(x["kind"], x["start"], x["end"], x["base"]))


def find(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans): all personal data of every whole text, as (kind, start, end, base), by kind and then start.

    ``base`` spans are the valid matches of a base pattern; the model, fitted on
    all candidates of ``docs``, adds spans and never takes a base one. Null texts
    are empty and have no span; a repeated row appears as often as it is given.
    """
    found = stored(candidates(docs.select(id, text), text=text).select(id, "candidates"), "pii")
    return found.select(id, accepted(fit(found)).alias("spans"))


def redact(docs: DataFrame, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """``docs`` with [KIND] in place of each span, and ``chars``, if there is such a column, set to the new length.

    Of spans that overlap, the first names the kind and all are covered. Texts without a span, null ones too, stay as they
    are; a repeated row appears as often as it is given; an empty table gives no rows. All columns are kept. The rows are
    stored with their candidates, which are looked for once, for the fit and for the result; that table has the texts as
    they were, so run it within a ``session.workspace`` that ends when the result is written.
    """
    found = stored(candidates(docs, "_pii", text), "pii-rows")
    rows = found.withColumn("_pii", F.array_sort(_placed(accepted(fit(found, "_pii"), "_pii"))))
    changed = rows.withColumn(text, F.when(F.size("_pii") > 0, _covered(F.col(text), F.col("_pii"))).otherwise(F.col(text)))
    if chars in docs.columns:
        length = F.when(F.size("_pii") > 0, F.length(text)).otherwise(F.col(chars))
        changed = changed.withColumn(chars, length.cast(docs.schema[chars].dataType))
    return changed.select(*docs.columns)


def _covered(text: Column, spans: Column) -> Column:
    """The text with a mark in place of sorted spans. It is cut into blocks first, so that a place is near the start of one."""
    block = 1024

    def piece(blocks: Column, start: Column, end: Column) -> Column:
        i, j = F.floor(start / block).cast("int"), F.floor(end / block).cast("int")
        at, to = (start % block).cast("int"), (end % block).cast("int")
        first, last = F.coalesce(F.get(blocks, i), F.lit("")), F.coalesce(F.get(blocks, j), F.lit(""))
        between = F.array_join(F.slice(blocks, i + 2, F.greatest(j - i - 1, F.lit(0))), "")
        across = F.concat(F.substring(first, at + 1, F.lit(block)), between, F.substring(last, F.lit(1), to))
        return F.when(i == j, F.substring(first, at + 1, to - at)).otherwise(across)

    def marked(blocks: Column, tops: Column) -> Column:
        def put(x: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(tops, i - 1)).otherwise(F.lit(0).cast("long"))
            mark = F.concat(piece(blocks, before, x["start"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
            return F.when(x["start"] >= before, mark).otherwise("")

        rest = piece(blocks, F.element_at(tops, -1), F.greatest(F.length(text).cast("long"), F.element_at(tops, -1)))
        return F.concat(F.array_join(F.transform(spans, put), ""), rest)

    tops = running(F.transform(spans, lambda x: x["end"]), F.greatest)
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    return let(blocks, lambda b: let(tops, lambda t: marked(b, t)))


def _placed(spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    found = find(docs)
    base: Callable[[Column], Column] = lambda x: x["base"]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in BASE],
        F.sha2(_joined(F.filter("spans", base)), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
