"""Language identification: the family first, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StringType, StructType

from snapstar.llm.common import appended, field, raw

#: Families of closely related languages. A code that isn't here is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nl nn no nb sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "turkic": "az kk ky tk tr tt ug uz",
    "indic": "as bn gu hi mr ne or pa sa sd si ur",
    "uralic": "et fi hu",
    "semitic": "am ar he mt ti",
}
UNKNOWN = "und"
SIZE = 4096
#: The classifier is fitted on so many labelled rows at most, shared evenly by the languages.
SAMPLE = 1600
ROUNDS, PENALTY = 30, 4.0


def family(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang.lower().partition("-")[0] in codes.split()), lang)


def features(texts: pa.Array) -> np.ndarray:
    """A row for each text: its byte trigrams, lower-cased and hashed, as unit vectors of square roots of counts.

    The whole text counts; a space is put before and after it.
    """
    data, at = raw(pc.binary_join_element_wise(" ", pc.utf8_lower(pc.fill_null(texts, "")), " ", ""))
    data = data[at[0] : at[-1]].astype(np.uint32)
    at = at - at[0]
    code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(0x9E3779B1) >> np.uint32(32 - SIZE.bit_length() + 1)
    found = np.zeros((len(texts), SIZE), np.float32)
    for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
        found[i] = np.bincount(code[a : max(a, b - 2)], minlength=SIZE)
    np.sqrt(found, out=found)
    found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)
    return found


def machine(rows: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """A linear support vector machine (weights, then the intercept) by dual coordinate descent."""
    x = np.hstack([rows, np.ones((len(rows), 1), np.float32)])
    y = np.where(positive, 1.0, -1.0)
    w, alpha, norm = np.zeros(x.shape[1]), np.zeros(len(x)), (x * x).sum(1)
    order = np.random.default_rng(0)
    for _ in range(ROUNDS):
        for i in order.permutation(len(x)):
            step = min(max(alpha[i] - (y[i] * (x[i] @ w) - 1) / norm[i], 0), PENALTY) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * x[i]
    return w.astype(np.float32)


class Model:
    """One machine for each family against the others, and one for each two languages of a family."""

    def __init__(self, rows: np.ndarray, langs: list[str]):
        langs = np.array(langs)
        self.langs = sorted(set(langs.tolist()))
        families = np.array([family(x) for x in langs])
        self.families = sorted(set(families.tolist()))
        self.within = [[x for x in self.langs if family(x) == f] for f in self.families]
        self.pairs = [list(combinations(range(len(w)), 2)) for w in self.within]
        self.outer = np.array([machine(rows, families == f) for f in self.families if len(self.families) > 1])
        self.inner = []
        for own, pairs in zip(self.within, self.pairs, strict=True):
            both = [np.isin(langs, (own[a], own[b])) for a, b in pairs]
            self.inner.append(np.array([machine(rows[k], langs[k] == own[a]) for k, (a, _) in zip(both, pairs, strict=True)]))

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The language of each row and how sure the two steps are (0 to 1)."""
        n = len(rows)
        if not self.langs:
            return np.full(n, UNKNOWN, object), np.zeros(n)
        if len(self.families) > 1:
            margins = rows @ self.outer[:, :-1].T + self.outer[:, -1]
            chosen, sure = margins.argmax(1), _chance(margins.max(1))
        else:
            chosen, sure = np.zeros(n, int), np.ones(n)
        found = np.empty(n, object)
        for f, (own, pairs, inner) in enumerate(zip(self.within, self.pairs, self.inner, strict=True)):
            at = np.flatnonzero(chosen == f)
            if len(own) == 1:
                found[at] = own[0]
            elif len(at):
                margins = rows[at] @ inner[:, :-1].T + inner[:, -1]
                votes = np.zeros((len(at), len(own)))
                for k, (a, b) in enumerate(pairs):
                    chance = _chance(margins[:, k])
                    votes[:, a] += (margins[:, k] > 0) + chance / (2 * len(pairs))
                    votes[:, b] += (margins[:, k] <= 0) + (1 - chance) / (2 * len(pairs))
                best = votes.argmax(1)
                won = [[(k, 1 if a == x else -1) for k, (a, b) in enumerate(pairs) if x in (a, b)] for x in range(len(own))]
                for x in range(len(own)):
                    mine = best == x
                    sure[at[mine]] *= np.mean([_chance(sign * margins[mine, k]) for k, sign in won[x]], axis=0)
                    found[at[mine]] = own[x]
        return found, sure


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-3 * np.clip(margin, -20, 20)))


def fit(docs: DataFrame, sample: int = SAMPLE, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model of the labelled rows of ``docs``, from a bounded sample: ``sample`` rows in all, chosen by a hash.

    Null labels and null texts don't count; without any labelled row the model knows no language.
    """
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = labelled.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(sample).collect()
    if not counts:
        return Model(np.zeros((0, SIZE), np.float32), [])
    each = max(1, sample // len(counts))
    mark = F.xxhash64(id, text)
    # About four times the rows that are wanted go on to be ranked, however many there are.
    share = F.create_map(*[F.lit(x) for r in counts for x in (r[0], min(1.0, 4 * each / r[1]))])
    some = labelled.filter(F.pmod(mark, F.lit(1 << 30)) <= F.element_at(share, F.col(lang)) * float(1 << 30))
    ranked = some.withColumn("_row", F.row_number().over(Window.partitionBy(lang).orderBy(mark, id)))
    rows = ranked.filter(F.col("_row") <= each).select(lang, text)

    def values(batch: pa.RecordBatch) -> list[pa.Array]:
        parts = (features(batch.column(1).slice(i, 256)) for i in range(0, len(batch), 256))
        return [pa.array([row.tobytes() for part in parts for row in part], pa.binary())]

    found = appended(rows, StructType([field("_features", BinaryType())]), values).select(lang, "_features").collect()
    found.sort(key=lambda r: (r[0], r[1]))
    return Model(np.frombuffer(b"".join(r[1] for r in found), np.float32).reshape(-1, SIZE), [r[0] for r in found])


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1), from the whole text alone.

    A null text, or one without a letter, is ``und`` with score 0, and so is
    every text for a model that knows no language. Of languages with equal votes
    and chances the first by code point wins. A repeated row appears as often as
    it is given, with the same result; an empty table gives no rows. Columns of
    these names are replaced, all others kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size depends on the languages alone

    def values(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column(batch.schema.get_field_index(text))
        letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        langs, scores = [], []
        for i in range(0, len(texts), 256):
            found, sure = shared.value.predict(features(texts.slice(i, 256)))
            langs.append(np.where(letters[i : i + 256], found, UNKNOWN))
            scores.append(np.where(letters[i : i + 256], sure, 0.0))
        return [pa.array(np.concatenate(langs or [[]]).tolist(), pa.string()), pa.array(np.concatenate(scores or [[]]), pa.float64())]

    return appended(docs, StructType([field("lang_pred", StringType()), field("score", DoubleType())]), values)


def held_out(id: str = "doc_id"):
    """Whether a row takes no part in fitting: crc32 of its id as text leaves 1 when divided by 3; false for a null id."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def digest(docs: DataFrame) -> DataFrame:
    model = fit(docs.filter(~held_out()))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
