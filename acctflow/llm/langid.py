"""Language identification by interpolated Kneser-Ney character models.

One character model per language, of order 4 over the letters of words (a word
is a run of letters, lower-cased, with a boundary sign at its ends). The counts
of 4-grams over the labelled texts are summed by Spark; the lower orders use
continuation counts (how many different characters stand before an n-gram),
and each order is interpolated with the next lower one by the discount
n1 / (n1 + 2 n2) of its own counts, down to a uniform distribution.

The models are sorted arrays of 64-bit hashes of n-grams and contexts beside a
matrix with one column per language, and lookups are binary searches over whole
batches of words. They are broadcast; ``max_grams`` bounds their size: if an
order holds more n-grams, those seen least are left to the lower orders (by
the smallest power of two as a count that fits). Totals, discounts and
continuation counts come from all n-grams in any case.

The language with the lowest cross-entropy per character wins. A text is
rejected when even that lies above what texts of the language reach. The limit
is calibrated on labelled texts kept out of the counts: from
the median cost of a language's texts two fifths of the way to their median cost
under the best other language, and for short texts, whose costs scatter more, up
to half the way, as far as ``sigmas`` robust deviations for their length need it.
All of it rests on medians, so no long or odd text weighs more than another.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctflow.llm.common import delete_folder, pieces, shared_folder, with_columns_of_text, written

ORDER = 4
BOUNDARY = " "
SLICE = 2 << 20  # bytes of text taken at a time
ALPHABET = 1 << 16  # the uniform floor spreads over this many characters
_RUNS = re.compile(r"[^\W\d_]+")


def words_of(chunk: str) -> list[str]:
    """Runs of letters in a lower-cased chunk."""
    if chunk.isalpha():
        return [chunk]
    return [w if w.isalpha() else "".join(c for c in w if c.isalpha()) for w in _RUNS.findall(chunk) if not w.isnumeric()]


def framed(words: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The words between boundary signs in one string, its code points, the
    positions that are predicted (letters and end signs), and the word of each."""
    pad = BOUNDARY * (ORDER - 1)
    text = "".join([pad + w + BOUNDARY for w in words])
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    sizes = np.array([len(w) for w in words], dtype=np.int64) + ORDER
    owner = np.repeat(np.arange(len(words)), sizes)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero(np.arange(len(points)) - first >= ORDER - 1)
    return text, points, at, owner[at]


def gram_hashes(points: np.ndarray, last: np.ndarray, size: int, kind: int) -> np.ndarray:
    """Hashes of the ``size`` characters that end at the positions ``last``."""
    h = np.full(len(last), 0x9E3779B97F4A7C15 * (2 * size + kind + 1) % (1 << 64), dtype=np.uint64)
    for back in range(size - 1, -1, -1):
        h = (h ^ points[last - back]) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(29)
    return h


GRAM, CONTEXT = 0, 1


@dataclass
class Model:
    """Sorted hashes of n-grams (discounted probability, 0 where unseen) and of
    contexts (weight of the lower order, 1 where unseen), a column per language."""

    langs: list[str]
    hashes: np.ndarray
    values: np.ndarray
    limits: dict[str, tuple[float, float, float]]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def look_up(self, hashes: np.ndarray, unseen: float) -> np.ndarray:
        if not len(self.hashes):
            return np.full((len(hashes), len(self.langs)), unseen)
        at = np.searchsorted(self.hashes, hashes).clip(max=len(self.hashes) - 1)
        found = self.values[at].astype(np.float64)
        found[self.hashes[at] != hashes] = np.nan
        return np.where(np.isnan(found), unseen, found)

    def word_costs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Negative log-probabilities (a column per language) and the number of
        predicted characters of each word."""
        if not words:
            return np.zeros((0, len(self.langs))), np.zeros(0)
        _, points, at, owner = framed(words)
        # A character's probability is that of its n-gram of the highest order: each of those is looked up once.
        _, first, which = np.unique(gram_hashes(points, at, ORDER, GRAM), return_index=True, return_inverse=True)
        at = at[first]
        p = np.full((len(at), len(self.langs)), 1.0 / ALPHABET)
        for size in range(1, ORDER + 1):
            weight = self.look_up(gram_hashes(points, at - 1, size - 1, CONTEXT), 1.0)
            p = self.look_up(gram_hashes(points, at, size, GRAM), 0.0) + weight * p
        cost = -np.log(p)
        n = len(words)
        sums = np.stack([np.bincount(owner, cost[which, k], n) for k in range(len(self.langs))], axis=1)
        return sums, np.bincount(owner, minlength=n).astype(float)


class Scorer:
    """Costs of whole texts; costs of chunks are kept in a bounded memo."""

    def __init__(self, model: Model, size: int = 300_000, block: int = 8_000):
        self.model, self.size, self.block = model, size, block
        self.rows: dict[str, int] = {}
        self.costs = np.zeros((0, len(model.langs) + 1))

    def _learn(self, chunks: set[str]) -> None:
        if len(self.rows) + len(chunks) > self.size:
            self.rows, self.costs = {}, self.costs[:0]
        new = [c for c in chunks if c not in self.rows]
        split = [words_of(c) for c in new]
        words = list(chain.from_iterable(split))
        owner = np.repeat(np.arange(len(new)), [len(w) for w in split])
        both = np.zeros((len(words), len(self.model.langs) + 1))
        for lo in range(0, len(words), self.block):
            costs, n = self.model.word_costs(words[lo : lo + self.block])
            both[lo : lo + self.block] = np.concatenate([costs, n[:, None]], axis=1)
        added = np.stack([np.bincount(owner, both[:, k], len(new)) for k in range(both.shape[1])], axis=1) if words else (
            np.zeros((len(new), both.shape[1]))
        )
        base = len(self.rows)
        self.rows.update(zip(new, range(base, base + len(new))))
        self.costs = np.concatenate([self.costs, added])

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropies per character (a column per language) and numbers of
        predicted characters; 0 characters where a text has no letter."""
        split = [t.lower().split() for t in texts]
        wanted = set().union(*split)
        if not wanted <= self.rows.keys():
            self._learn(wanted if len(self.rows) + len(wanted) > self.size else wanted - self.rows.keys())
        get = self.rows.__getitem__
        sums = np.zeros((len(texts), len(self.model.langs) + 1))
        for i, s in enumerate(split):
            if s:
                sums[i] = self.costs[np.fromiter(map(get, s), dtype=np.int64, count=len(s))].sum(axis=0)
        n = sums[:, -1]
        return sums[:, :-1] / np.maximum(n, 1)[:, None], n


_held: dict[str, Scorer] = {}


def scorer_of(model: Model) -> Scorer:
    """The scorer of a model in this Python worker, with its memo from the
    tasks before; one model's at a time."""
    if model.key not in _held:
        _held.clear()
        _held[model.key] = Scorer(model)
    return _held[model.key]


def gram_counts(labelled: DataFrame, flush_words: int = 50_000) -> DataFrame:
    """(lang, gram, n): counts of 4-grams over ``labelled`` (lang, text). Tasks
    count words in a bounded table first and send sums."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])

    def grams(lang: str, words: Counter) -> pa.RecordBatch:
        found: Counter = Counter()
        for chunk, n in words.items():
            for w in words_of(chunk):
                found[w] += n
        names = list(found)
        if not names:
            return pa.RecordBatch.from_pylist([], schema=schema)
        text, points, at, owner = framed(names)
        weight = np.fromiter(found.values(), dtype=np.int64, count=len(names))[owner]
        _, first, inverse = np.unique(gram_hashes(points, at, ORDER, GRAM), return_index=True, return_inverse=True)
        total = np.bincount(inverse, weight).astype(np.int64)
        taken = [text[i - ORDER + 1 : i + 1] for i in at[first].tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(taken), pa.string()), pa.array(taken, pa.string()), pa.array(total)], schema=schema
        )

    def run(batches):
        held: dict[str, Counter] = {}
        for batch in pieces(batches, max_bytes=SLICE):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, Counter()).update(text.lower().split())
            if sum(map(len, held.values())) > flush_words:
                for lang, words in held.items():
                    yield grams(lang, words)
                held = {}
        for lang, words in held.items():
            yield grams(lang, words)

    return labelled.mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def order_rows(counts: DataFrame, size: int, max_grams: int) -> DataFrame:
    """(lang, kind, gram, value) of one order, from (lang, gram, n)."""
    seen = counts.groupBy("lang").agg(
        F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("n") == 2, 1).otherwise(0)).alias("n2"),
    )
    ones, twos = F.col("n1").cast("double"), F.col("n2").cast("double")
    discounts = seen.select(
        "lang", F.when(ones > 0, F.least(ones / (ones + 2 * twos), F.lit(0.95))).otherwise(0.5).alias("discount")
    )
    context = F.substring("gram", 1, size - 1) if size > 1 else F.lit("")
    # One row per character that follows: a context holds no more than the alphabet.
    same = Window.partitionBy("lang", "context")
    with_totals = (
        counts.withColumn("context", context)
        .withColumn("total", F.sum("n").over(same))
        .withColumn("types", F.count(F.lit(1)).over(same))
        .join(F.broadcast(discounts), "lang")  # one row per language
    )
    powers = counts.agg(*[F.sum(F.when(F.col("n") >= 2**k, 1).otherwise(0)).alias(f"p{k}") for k in range(50)]).head()
    least = next((2**k for k in range(50) if (powers[k] or 0) <= max_grams), 2**50)
    kept = with_totals.where(F.col("n") >= least)
    grams = kept.select(
        "lang", F.lit(GRAM).alias("kind"), "gram",
        (F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")).alias("value"),
    )
    contexts = kept.select(
        "lang", F.lit(CONTEXT).alias("kind"), F.col("context").alias("gram"),
        (F.col("discount") * F.col("types") / F.col("total")).alias("value"),
    ).distinct()
    return grams.unionByName(contexts).select("lang", F.lit(size).alias("size"), "kind", "gram", "value")


def train(labelled: DataFrame, calibration: DataFrame, max_grams: int = 1_000_000, sigmas: float = 4.0) -> Model:
    """A model that counts ``labelled`` (lang, text), its limits from
    ``calibration`` (lang, text). At most ``max_grams`` n-grams an order reach the
    driver."""
    folder = shared_folder(labelled.sparkSession, "langid")
    model = model_of(gram_counts(labelled), f"{folder}/counts", max_grams)
    if model.langs:
        model.limits = _limits(calibration, model, f"{folder}/scored", sigmas)
    delete_folder(labelled.sparkSession, folder)
    return model


def model_of(grams: DataFrame, folder: str, max_grams: int) -> Model:
    """The arrays of the model of counted 4-grams (lang, gram, n)."""
    counts = written(grams, f"{folder}/{ORDER}")
    rows = order_rows(counts, ORDER, max_grams)
    for size in range(ORDER - 1, 0, -1):
        # Continuation counts: one n-gram of the next order per character before.
        shorter = counts.groupBy("lang", F.substring("gram", 2, size).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        counts = written(shorter, f"{folder}/{size}")
        rows = rows.unionByName(order_rows(counts, size, max_grams))
    return _arrays(rows.toArrow())


def _arrays(table: pa.Table) -> Model:
    langs = sorted(set(table.column("lang").to_pylist()))
    column = {lang: k for k, lang in enumerate(langs)}
    hashes = np.zeros(table.num_rows, dtype=np.uint64)
    size, kind = (table.column(c).to_numpy() for c in ("size", "kind"))
    gram = np.array(table.column("gram").to_pylist(), dtype=object)
    for s in range(1, ORDER + 1):
        for k in (GRAM, CONTEXT):
            at = np.flatnonzero((size == s) & (kind == k))
            n = s - (k == CONTEXT)
            points = np.frombuffer("".join(gram[at]).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
            last = np.arange(len(at)) * n + n - 1
            hashes[at] = gram_hashes(points, last, n, k)
    order, inverse = np.unique(hashes, return_inverse=True)
    values = np.full((len(order), len(langs)), np.nan, dtype=np.float32)
    values[inverse, [column[x] for x in table.column("lang").to_pylist()]] = table.column("value").to_numpy()
    return Model(langs, order, values, {})


#: Texts below this length show the scatter per character; a language with fewer
#: than ``OWN_SCATTER`` of them takes that of all languages.
SHORT, OWN_SCATTER = 400, 30
NEAR, FAR = 0.4, 0.5


def limit(n: np.ndarray, center: np.ndarray, gap: np.ndarray, noise: np.ndarray) -> np.ndarray:
    """The highest accepted cost of texts of ``n`` characters."""
    return center + np.clip(noise / np.sqrt(np.maximum(n, 1)), NEAR * gap, FAR * gap)


def _limits(calibration: DataFrame, model: Model, folder: str, sigmas: float) -> dict[str, tuple[float, float, float]]:
    """Per language: the median cost of its texts, how far above it their median
    cost under the best other language lies (as high again without another), and
    ``sigmas`` times the robust deviation of one character's cost."""
    sent = calibration.sparkSession.sparkContext.broadcast(model)
    langs = list(model.langs)

    def run(batches):
        scorer = scorer_of(sent.value)
        for batch in pieces(batches, max_bytes=SLICE):
            lang = batch.column(0).to_pylist()
            costs, n = scorer.texts(batch.column(1).to_pylist())
            ok = [i for i, x in enumerate(lang) if x in langs and n[i] > 0]
            place = [langs.index(lang[i]) for i in ok]
            own = np.array([costs[i, k] for i, k in zip(ok, place)])
            other = np.array([np.delete(costs[i], k).min() if len(langs) > 1 else 2 * costs[i, k] for i, k in zip(ok, place)])
            made = [pa.array([lang[i] for i in ok], pa.string()), *(pa.array(x, pa.float64()) for x in (own, other, n[ok]))]
            yield pa.RecordBatch.from_arrays(made, names=["lang", "cost", "other", "n"])

    scored = written(calibration.select("lang", "text").mapInArrow(run, "lang string, cost double, other double, n double"), folder)
    medians = scored.groupBy("lang").agg(*[F.percentile_approx(c, 0.5).alias(c) for c in ("cost", "other")]).collect()
    if not medians:
        return {}
    center = F.create_map(*[F.lit(x) for r in medians for x in (r["lang"], r["cost"])])
    off = F.abs(F.col("cost") - center[F.col("lang")]) * F.sqrt("n")
    short = scored.where(F.col("n") < SHORT).select("lang", off.alias("off"))
    middle = [F.percentile_approx("off", 0.5).alias("off"), F.count(F.lit(1)).alias("k")]
    all_langs = short.agg(*middle).head()["off"] or 0.0
    own = {r["lang"]: r["off"] for r in short.groupBy("lang").agg(*middle).collect() if r["k"] >= OWN_SCATTER}
    # 1.4826 times the median deviation is the standard deviation of a normal law.
    return {r["lang"]: (r["cost"], max(r["other"] - r["cost"], 0.0), sigmas * 1.4826 * own.get(r["lang"], all_langs)) for r in medians}


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
    evidence: int = 50,
) -> DataFrame:
    """Per row: the id (or the columns in ``keep``), ``lang_pred``, ``score``,
    ``cross_entropy`` and ``accepted``.

    ``lang_pred`` is a learned language, or ``und`` if the text is null or has
    no letter (or nothing was learned); those have score 0 and are rejected.
    ``score`` is the posterior of the winner over the learned languages, with
    at most ``evidence`` characters counted as independent. No shuffle; repeated
    rows give repeated results; null ids stay null.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = sent.value
        scorer = scorer_of(m)
        limits = np.array([m.limits.get(x, (0.0, np.inf, 0.0)) for x in m.langs]).reshape(-1, 3)

        def arrays(texts: list[str]) -> list[pa.Array]:
            costs, n = scorer.texts(texts) if m.langs else (np.zeros((len(texts), 1)), np.zeros(len(texts)))
            best = costs.argmin(axis=1)
            low = costs[np.arange(len(texts)), best]
            odds = np.exp(-(costs - low[:, None]) * np.minimum(n, evidence)[:, None]).sum(axis=1)
            known = n > 0
            accepted = known.copy()
            if m.langs:
                accepted &= low <= limit(n, *limits[best].T)
            return [
                pa.array([m.langs[b] if k else "und" for b, k in zip(best, known)], pa.string()),
                pa.array(np.where(known, 1 / odds, 0.0)),
                pa.array([float(x) if k else None for x, k in zip(low, known)], pa.float64()),
                pa.array(accepted),
            ]

        return arrays

    added = "lang_pred string, score double, cross_entropy double, accepted boolean"
    return with_columns_of_text(docs, text_col, keep or (id_col,), added, make, SLICE)


def fold(id_col: str = "doc_id", folds: int = 5) -> F.Column:
    """crc32 of the id as text, mod ``folds``; a null id is in no fold."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def train_on_folds(docs: DataFrame, max_grams: int = 1_000_000) -> Model:
    """Counts from the labelled texts of folds 2 to 4, limits from fold 1;
    fold 0 is held out. Rows without lang, text or id teach nothing; nor does a
    language that only fold 1 holds."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    number = fold()
    return train(
        usable.where(number > 1).select("lang", "text"), usable.where(number == 1).select("lang", "text"), max_grams
    )
