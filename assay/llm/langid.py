"""Language identification: language family first, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from assay.llm.textkit import U64, mix, short_batches, slices

#: Families of common languages, by ISO 639-1 code. A language not listed is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz", "ky"],
    "indic": ["hi", "ur", "bn", "mr", "ne", "gu", "pa"],
    "semitic": ["ar", "he", "mt", "am"],
}
_WIDTH = 1 << 12
_rng = np.random.default_rng(77)
_TURN = _rng.integers(1, 2**63, 4, dtype=np.uint64) | U64(1)


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), lang)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text is divisible by ``folds``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def grams(texts: list[str], width: int = _WIDTH) -> np.ndarray:
    """Hashed counts of 1- to 3-grams of letters, lower-cased, with word edges; square-rooted and of unit length.

    Every run of other characters counts as one edge. Whole texts are read.
    """
    out = np.zeros((len(texts), width), np.float32)
    for lo, hi in slices([len(t) for t in texts], 500_000):
        codes, owner = [], []
        for k in range(lo, hi):
            c = np.frombuffer((" " + texts[k].lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
            letter = _letters(c)
            c = np.where(letter, c, 32)
            c = c[letter | np.concatenate([[True], letter[:-1]])]
            codes.append(c)
            owner.append(np.full(len(c), k - lo, np.int64))
        c, o = np.concatenate(codes).astype(U64), np.concatenate(owner)
        rolled = np.zeros(len(c), U64)
        for n in range(3):
            m = len(c) - n
            rolled = rolled[:m] + (c[n:] + U64(1)) * _TURN[n]
            same = o[:m] == o[n:]
            if n == 0:
                same = same & (c != 32)
            slot = (mix(rolled[same] + _TURN[3] * U64(n)) % U64(width)).astype(np.int64)
            out[lo:hi] += np.bincount(o[:m][same] * width + slot, minlength=(hi - lo) * width).reshape(hi - lo, width)
    out = np.sqrt(out)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


_LETTER = np.array([chr(c).isalpha() for c in range(0x3000)])


def _letters(c: np.ndarray) -> np.ndarray:
    """Which code points are letters: exactly below U+3000, beyond it all but private use and signs count."""
    return np.where(c < 0x3000, _LETTER[np.minimum(c, 0x2FFF)], (c > 0x3040) & ~((c >= 0xE000) & (c < 0xF900)) & (c < 0x1F000) | (c >= 0x20000))


def has_letters(text: Column) -> Column:
    """Whether a text (not null) has any letter."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 100) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by accelerated gradient; y is +1 or -1.

    The classes weigh the same whatever their counts.
    """
    n, d = x.shape
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * c
    w, b = np.zeros(d, np.float32), 0.0
    vw, vb, t = w, b, 1.0
    penalty = 1e-4
    step = 1 / (4 * c + penalty)  # rows have unit length, and the bias adds one
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ vw + vb))
        g = (-2 * weight * y * slack).astype(np.float32)
        nw, nb = (vw - step * (x.T @ g + penalty * vw)).astype(np.float32), vb - step * float(g.sum())
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        m = (t - 1) / t2
        vw, vb = (nw + m * (nw - w)).astype(np.float32), nb + m * (nb - b)
        w, b, t = nw, nb, t2
    return w, b


def _scale(margin: np.ndarray, y: np.ndarray) -> float:
    """The slope that makes a sigmoid of the margins most likely, by a search over a grid."""
    grid = np.geomspace(0.5, 20, 24)
    loss = [np.logaddexp(0, -y * margin * s).mean() for s in grid]
    return float(grid[int(np.argmin(loss))])


class Model:
    """Family classifiers (one against the rest) and, in each family, a machine for each pair of languages."""

    def __init__(self, x: np.ndarray, lang: np.ndarray):
        self.langs = sorted(set(lang))
        fam = np.array([family_of(v) for v in lang])
        self.families = sorted(set(fam))
        self.members = {f: sorted(set(lang[fam == f])) for f in self.families}
        self.heads = {f: self._machine(x, np.where(fam == f, 1.0, -1.0)) for f in self.families} if len(self.families) > 1 else {}
        self.pairs = {}
        for f in self.families:
            own = self.members[f]
            for i, a in enumerate(own):
                for b in own[i + 1 :]:
                    at = np.flatnonzero((lang == a) | (lang == b))
                    self.pairs[a, b] = self._machine(x[at], np.where(lang[at] == a, 1.0, -1.0))

    @staticmethod
    def _machine(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, float]:
        w, b = fit_svm(x, y)
        return w.astype(np.float32), b, _scale(x @ w + b, y)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each row: the family's share times the language's share of its pairs' votes."""
        sure = lambda m: 1 / (1 + np.exp(-np.clip(m[2] * (x @ m[0] + m[1]), -30, 30)))
        n = len(x)
        share = np.stack([sure(self.heads[f]) for f in self.families], axis=1) if self.heads else np.ones((n, 1))
        share = share / share.sum(axis=1, keepdims=True)
        pick = share.argmax(axis=1)
        lang, score = np.empty(n, object), np.zeros(n)
        votes = {p: sure(m) for p, m in self.pairs.items()}
        for k, f in enumerate(self.families):
            own = self.members[f]
            won = np.zeros((n, len(own)))
            for i, a in enumerate(own):
                for j in range(i + 1, len(own)):
                    v = votes[a, own[j]]
                    won[:, i] += v
                    won[:, j] += 1 - v
            won = won / max(1, len(own) * (len(own) - 1) / 2) if len(own) > 1 else np.ones((n, 1))
            best = won.argmax(axis=1)
            at = pick == k
            lang[at] = np.array(own, object)[best[at]]
            # with m languages a sure winner holds 2 / m of all votes
            score[at] = share[at, k] * np.minimum(1, won[at, best[at]] * (len(own) / 2 if len(own) > 1 else 1))
        return lang, score


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for lo in range(0, len(texts), 256):
            x = grams(texts[lo : lo + 256]).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 256), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "x"])


def _judge(texts: list[str | None], spoken: pa.Array, model: Model | None) -> tuple[np.ndarray, np.ndarray]:
    lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
    at = np.flatnonzero(np.array(spoken.to_pylist(), bool))
    for lo in range(0, len(at), 256):
        part = at[lo : lo + 256]
        if model:
            lang[part], score[part] = model.predict(grams([texts[k] for k in part]))
    return lang, score


def _predict(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for batch in short_batches(batches, lambda b: b.column("text")):
        lang, score = _judge(batch.column("text").to_pylist(), batch.column("spoken"), model)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("out"), pa.array(lang.tolist(), pa.string()), pa.array(score)], ["id", "held_out", "lang_pred", "score"])


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, sample_per_language: int = 500, most_languages: int = 100, most_texts: int = 20_000, folds: int = 5
) -> Model | None:
    """A model learned from distinct texts with a non-null label whose id isn't held out.

    At most ``sample_per_language`` texts of each language and ``most_texts`` in all, of the ``most_languages`` commonest labels: those that
    come first by a hash of the text, so the sample is the same whatever the partitions and however often a text is
    repeated. Its features (8 KB a text) are the only thing the driver gathers. Null where nothing can be learned from.
    """
    text, lang = F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    known = docs.where(lang.isNotNull() & has_letters(text) & ~held_out(F.col(id_col), folds) & F.col(id_col).isNotNull()).select(lang.alias("lang"), text.alias("text"), F.xxhash64(text).alias("spot"))
    counts = known.groupBy("lang").agg(F.count("*").alias("count"), F.approx_count_distinct("spot", 0.02).alias("texts"))
    counts = {r[0]: max(1, r[2]) for r in counts.orderBy(F.desc("count"), "lang").limit(most_languages).collect()}
    if not counts:
        return None
    each = max(1, min(sample_per_language, most_texts // len(counts)))
    # half as many again, so that the first ``each`` are among them; copies of a text join before the shuffle
    keep = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, 1.5 * (each + 20) / n))])
    likely = known.where(F.pmod("spot", F.lit(1 << 30)) / float(1 << 30) < keep[F.col("lang")]).groupBy("lang", "spot").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.pmod("spot", F.lit(1 << 30)), "spot")
    sample = likely.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each).select("lang", "text")
    got = sample.mapInArrow(_features, "lang string, x binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r[0], r[1]))
    x = np.stack([np.frombuffer(r[1], np.float16) for r in got]).astype(np.float32)
    return Model(x, np.array([r[0] for r in got], object))


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", *, folds: int = 5) -> DataFrame:
    """One row ``(id, held_out, lang_pred, score)`` per row of ``docs``; only the text decides.

    Whole texts are read. A text that is null or has no letter gets ``und`` and score 0, as does every text
    without a model. Repeated rows and null ids keep their rows; an empty table gives an empty result; other
    columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col), folds).alias("out"), F.col(text_col).cast("string").alias("text"), has_letters(F.col(text_col)).alias("spoken"))
    schema = rows.select("id").schema.add("held_out", "boolean").add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(lambda it: _predict(it, model), schema)


def _keep(batches: Iterator[pa.RecordBatch], model: Model | None, place: int, least: float) -> Iterator[pa.RecordBatch]:
    for batch in short_batches(batches, lambda b: b.column("row").field(place)):
        lang, score = _judge(batch.column("row").field(place).to_pylist(), batch.column("spoken"), model)
        kept = batch.filter(pa.array((lang != "und") & (score >= least)))
        yield kept.select(["row"])


def recognised(docs: DataFrame, model: Model | None, text_col: str = "text", *, least: float = 0.2) -> DataFrame:
    """The rows of ``docs`` whose text has a language with a score of ``least`` and more, with all their columns.

    Rows travel to Python once. Texts that are null, empty or without letters go, as does every row without a model; repeated
    rows and null ids stay; columns may have any names; an empty table gives an empty result.
    """
    rows = docs.select(F.struct("*").alias("row"), has_letters(F.col(text_col).cast("string")).alias("spoken"))
    place = docs.columns.index(text_col)
    return rows.mapInArrow(lambda it: _keep(it, model, place, least), rows.select("row").schema).select("row.*")
