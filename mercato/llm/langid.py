"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text becomes the letters of its words in lower case with one boundary
between words; every run of 2 to 4 of them without a boundary inside is a
subword, hashed to one of ``BUCKETS``.  The text is the mean of its subwords'
embeddings; class scores are linear in it.  Embeddings and weights are
trained together by stochastic gradient descent in numpy on a bounded
sample (``PER_LANG`` documents of each language, taken by hash), on the
driver.

A part of the sample that is not trained on calibrates the model.  What it
must reject is made from that part: each text with its own language left out
of the model (an unlearned language), and each with its letters shuffled
(noise).  The temperature is the one at which texts of known languages get
their language and the others get all languages alike.  Rejection goes by how
usual a text's subwords are in the language predicted, as softmax
probabilities say only which of the languages fits best: the mean of log
(share of the subword in that language's training texts / share if all
were alike), standardised by what texts of that length vary by.  The
threshold is the value that ``REJECT_SHARE`` of the rightly recognised
calibration texts fall under; if the value that ``FOREIGN_SHARE`` of the
unlearned languages and the noise fall under is lower still, the middle of the
two, as the lowest of few texts says little.  The shares of calibration texts, of unlearned
languages and of noise that this accepts or rejects are kept in the model.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import held, partitions, parts

#: Bound of the training sample: documents of each language, and languages.
PER_LANG, MAX_LANGS = 600, 200
BUCKETS, DIMENSIONS, EPOCHS, RATE = 1 << 14, 16, 6, 2.0
REJECT_SHARE = 0.002
FOREIGN_SHARE = 0.98
#: Standard deviations below the mean under which ``REJECT_SHARE`` of a normal distribution lies.
TAIL = -2.878
#: Training takes so many steps at least, as a small sample is not learned in ``EPOCHS`` passes.
STEPS = 6000
#: Subwords that a document counts for at most in its language's shares, and the count that every bucket is given besides.
WEIGHT, PRIOR = 1000, 0.5
#: Texts of at least so many subwords vary by their content; in a shorter one a letter's subwords depend on each other.
LONG, DEPENDENT = 300, 3
#: Code points whose subwords are held at once.
BLOCK = 400_000
#: Subwords from which on a text's are counted by bucket.
DENSE = 2000
UNDETERMINED = "und"


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low[0])
    return table


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(letter_table())
    return _LETTERS[0]


def pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of texts of about ``BLOCK`` code points, with their places; a longer text is cut at a space."""
    places: list[int] = []
    group: list[str] = []
    size = 0
    for k, text in enumerate(texts):
        text = text or ""
        while text:
            end = len(text)
            if end > BLOCK:
                end = text.rfind(" ", 1, BLOCK) + 1 or BLOCK
            if size + end > BLOCK and group:
                yield places, group
                places, group, size = [], [], 0
            places.append(k)
            group.append(text[:end])
            size += end
            text = text[end:]
    if group:
        yield places, group


def subwords(group: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every subword of a group of texts, and its text's place in the group."""
    joined = "\0".join(group) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    x = letters()[points]
    ends = np.cumsum([len(t) + 1 for t in group])
    owner = np.repeat(np.arange(len(group), dtype=np.int32), np.diff(ends, prepend=0))
    keep = x != 0
    keep[1:] |= x[:-1] != 0
    x, owner = x[keep], owner[keep]
    if len(x) and x[0]:
        x, owner = np.concatenate([[np.uint32(0)], x]), np.concatenate([owner[:1], owner])
    found, owners = [], []
    h = x * np.uint32(0x9E3779B1)
    for n in (2, 3, 4):
        if len(x) < n:
            break
        h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + x[n - 1:] * np.uint32(0xC2B2AE3D)
        inside = x[1:len(x) - n + 2] != 0  # the second symbol of a subword is always inside it
        for k in range(2, n - 1):
            inside = inside & (x[k:len(x) - n + 1 + k] != 0)
        inside = inside[:len(h)]
        if n == 2:
            inside = inside | (x[:-1] != 0)
        mixed = h ^ (h >> np.uint32(13))
        found.append(((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(18))[inside])
        owners.append(owner[1:len(h) + 1][inside] if n > 2 else np.where(x[:-1] != 0, owner[:-1], owner[1:])[inside])
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32)
    return np.concatenate(found), np.concatenate(owners)


def shuffled(text: str) -> str:
    """The text with its letters in another order, the same each time."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    at = np.flatnonzero(letters()[points])
    points[at] = points[at][np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass"))).permutation(len(at))]
    return points.tobytes().decode("utf-32-le", "surrogatepass")


@dataclass
class Model:
    langs: list[str]
    #: Score of each bucket for each language: embeddings times weights.
    scores: np.ndarray
    #: How usual each bucket is in each language, and what a language's texts have on average and vary by.
    usual: np.ndarray
    middle: np.ndarray
    spread: np.ndarray
    between: float = 1e-6
    temperature: float = 1.0
    threshold: float = float("-inf")
    #: Shares of the calibration texts: recognised, accepted when recognised, rejected without their language, rejected when shuffled.
    held_out_accuracy: float = field(default=float("nan"))
    accepts_known: float = field(default=float("nan"))
    rejects_unlearned: float = field(default=float("nan"))
    rejects_noise: float = field(default=float("nan"))

    def fitting(self, usual: np.ndarray, best: np.ndarray, n: np.ndarray) -> np.ndarray:
        """How far the texts' mean ``usual`` is above the middle of their language ``best``, in units of what texts of ``n`` subwords vary by."""
        return (usual - self.middle[best]) / np.sqrt(self.between + self.spread[best] / np.maximum(n, 1))

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, calibrated probability and whether the text is accepted; without a letter ``und``, 0 and not."""
        tables = np.concatenate([self.scores, self.usual]).astype(float)
        by_bucket = np.ascontiguousarray(tables.T)
        sums, count = np.zeros((len(texts), len(tables))), np.zeros(len(texts))
        for places, group in pieces(texts):
            where, owner = subwords(group)
            where = where[np.argsort(owner, kind="stable")]
            ends = np.cumsum(np.bincount(owner, minlength=len(group)))
            for place, found in zip(places, np.split(where, ends[:-1])):
                count[place] += len(found)
                # many subwords are counted by bucket first, few are looked up each
                sums[place] += tables @ np.bincount(found, minlength=BUCKETS) if len(found) > DENSE else by_bucket[found].sum(axis=0)
        total, usual = np.split(sums, 2, axis=1)
        if not self.langs:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts), [False] * len(texts)
        n = np.maximum(count, 1)
        p = softmax(total / n[:, None] / self.temperature)
        best = p.argmax(axis=1)
        known = count > 0
        ok = known & (self.fitting(usual[np.arange(len(best)), best] / n, best, n) >= self.threshold)
        langs = [self.langs[b] if k else UNDETERMINED for b, k in zip(best, known)]
        return langs, np.where(known, p.max(axis=1), 0.0).tolist(), ok.tolist()

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        return self.judge(texts)[:2]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str | None, bool, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """Fits a model to (language, whether it calibrates, buckets, counts) rows; rows without a language are noise to be rejected."""
    noise = [r for r in rows if r[0] is None and len(r[2])]
    rows = [r for r in rows if r[0] is not None and len(r[2])]
    langs = sorted({r[0] for r in rows})
    if not langs:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros((0, BUCKETS), np.float32), np.zeros(0), np.zeros(0))
    number = {x: k for k, x in enumerate(langs)}
    fit = [r for r in rows if not r[1]] or rows
    rng = np.random.default_rng(seed)
    embed = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    weight = np.zeros((DIMENSIONS, len(langs)))
    epochs = max(EPOCHS, -(-STEPS // len(fit)))
    steps, done = epochs * len(fit), 0
    for _ in range(epochs):
        for k in rng.permutation(len(fit)):
            lang, _, where, counts = fit[k]
            rate = RATE * (1 - done / steps)
            share = counts / counts.sum()
            mean = share @ embed[where]
            slope = softmax(mean @ weight)
            slope[number[lang]] -= 1
            back = weight @ slope
            weight -= rate * np.outer(mean, slope)
            embed[where] -= rate * share[:, None] * back
            done += 1
    scores = (embed @ weight).T.astype(np.float32).copy()
    return calibrated(langs, scores, usualness(fit, number), [r for r in rows if r[1]] or rows, noise)


def usualness(fit: list, number: dict[str, int]) -> np.ndarray:
    """For each language and bucket the log of the bucket's share in the language's texts, against equal shares."""
    counts = np.full((len(number), BUCKETS), PRIOR)
    for lang, _, where, n in fit:
        counts[number[lang], where] += n * min(1.0, WEIGHT / n.sum())
    return np.log(counts / counts.sum(axis=1, keepdims=True) * BUCKETS).astype(np.float32)


def means(rows: list, tables: np.ndarray) -> np.ndarray:
    """For each row and table the mean of the row's subwords."""
    return np.array([(tables[:, r[2]] @ r[3]) / r[3].sum() for r in rows], float).reshape(len(rows), len(tables))


def temperature(known: np.ndarray, truth: np.ndarray, unknown: list[np.ndarray]) -> float:
    """Where known texts get their language and unknown ones all languages alike; 1 if there are no unknown ones, as no value is best then."""
    unknown = [z for z in unknown if z.size and z.shape[1] > 1]
    if not unknown:
        return 1.0
    low, high = 0.05, 20.0
    while True:
        grid = np.geomspace(low, high, 60)
        log = lambda z, t: np.log(softmax(z / t) + 1e-12)
        losses = [-log(known, t)[np.arange(len(truth)), truth].mean() - sum(log(z, t).mean(axis=1).sum() for z in unknown) / sum(map(len, unknown)) for t in grid]
        k = int(np.argmin(losses))
        if 0 < k < len(grid) - 1 or low < 1e-6:
            return float(grid[k])
        low, high = low / 20, high * 20


def calibrated(langs: list[str], scores: np.ndarray, usual: np.ndarray, check: list, noise: list) -> Model:
    """The model with temperature and threshold from the rows ``check``, their own languages left out, and ``noise``."""
    every = range(len(langs))
    truth = np.array([langs.index(r[0]) for r in check])
    n = np.array([r[3].sum() for r in check])
    logits, typical = means(check, scores), means(check, usual)
    best = logits.argmax(axis=1)
    right = best == truth
    share = np.exp(usual.astype(float)) / BUCKETS
    expected = (share * usual).sum(axis=1)
    spread = DEPENDENT * (share * (usual - expected[:, None]) ** 2).sum(axis=1)
    own = [typical[(truth == k) & right, k] for k in every]
    middle = np.array([np.median(x) if len(x) else expected[k] for k, x in enumerate(own)])
    off = typical[np.arange(len(truth)), best] - middle[best]
    long = off[right & (n >= LONG)]
    # by the tail and not the bulk of long texts: junk among them must not loosen the limit of short ones
    model = Model(langs, scores, usual, middle, spread, max((float(np.quantile(long, REJECT_SHARE)) / TAIL) ** 2, 1e-6) if len(long) else 1e-6)
    fits = model.fitting(typical[np.arange(len(truth)), best], best, n)
    noise_logits = means(noise, scores)
    left_out = [np.delete(logits[truth == k], k, axis=1) for k in every]
    model.temperature = temperature(logits, truth, [*left_out, noise_logits])
    unlearned, strange = np.zeros(0), np.zeros(0)
    if len(langs) > 1:
        others = logits.copy()
        others[np.arange(len(truth)), truth] = -np.inf
        second = others.argmax(axis=1)
        unlearned = model.fitting(typical[np.arange(len(truth)), second], second, n)
    if noise:
        taken = noise_logits.argmax(axis=1)
        strange = model.fitting(means(noise, usual)[np.arange(len(taken)), taken], taken, np.array([r[3].sum() for r in noise]))
    if right.any():
        low = float(np.quantile(fits[right], REJECT_SHARE))
        foreign = np.concatenate([unlearned, strange])
        high = float(np.quantile(foreign, FOREIGN_SHARE)) if len(foreign) else low
        model.threshold = min(low, (low + high) / 2)
        model.accepts_known = float((fits[right] >= model.threshold).mean())
    model.held_out_accuracy = float(right.mean())
    model.rejects_unlearned, model.rejects_noise = (float((x < model.threshold).mean()) if len(x) else float("nan") for x in (unlearned, strange))
    return model


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from: crc32 of its id as text is 0 modulo 5 (so is a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trains on a sample of the documents that are not held out: about ``PER_LANG`` of each language.

    A document is in the sample if the hash of its id is small enough for its
    language's share; the counts behind the shares cover all documents.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    sizes = known.groupBy(F.col(lang_col).cast("string").alias("lang")).count().limit(MAX_LANGS + 1).collect()
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages; the sample of {PER_LANG} documents each would be too large for the driver")
    if not sizes:
        return train([])
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("language sample")), F.lit(1 << 30))
    share = F.lit(0)
    for r in sizes:
        share = F.when(F.col(lang_col).cast("string") == r["lang"], F.lit(min(1 << 30, int((1 << 30) * PER_LANG / r["count"])))).otherwise(share)
    calibrates = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("calibration")), F.lit(4)) == 0
    sample = (known.where(draw < share).select(F.col(lang_col).cast("string").alias("lang"), calibrates.alias("calibrates"), F.col(text_col).cast("string").alias("text"))
              .limit(2 * PER_LANG * len(sizes)).repartition(partitions(docs.sparkSession)))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, ones, where, counts = [], [], [], []
            for lang, calibrating, text in zip(*[c.to_pylist() for c in batch.columns]):
                for noise in (False, True)[:1 + calibrating]:
                    total = np.zeros(BUCKETS, np.int64)
                    for _, group in pieces([text]):
                        total += np.bincount(subwords([shuffled(t) for t in group] if noise else group)[0], minlength=BUCKETS)
                    at = np.flatnonzero(total)
                    langs.append(None if noise else lang)
                    ones.append(calibrating)
                    where.append(at.astype(np.int32).tobytes())
                    counts.append(np.minimum(total[at], 1 << 30).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(ones, pa.bool_()), pa.array(where, pa.binary()), pa.array(counts, pa.binary())], names=["lang", "calibrates", "at", "n"])

    found = sample.mapInArrow(features, "lang string, calibrates boolean, at binary, n binary").collect()
    return train(sorted(((r["lang"], r["calibrates"], np.frombuffer(r["at"], np.int32), np.frombuffer(r["n"], np.int32).astype(float)) for r in found), key=lambda r: (r[0] is None, r[0] or "", r[2].tobytes(), r[3].tobytes())))


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Predicts the language of every whole text in one pass: ``doc_id, held_out, lang_pred, score, accepted``.

    Null, empty and letterless texts are ``und`` with score 0 and not
    accepted; texts in a language never learned, or in none, are told by
    subwords unusual in the predicted one and not accepted either.  Documents
    with a null language or id are predicted but never
    learned from; without any labelled document everything is ``und``.
    Repeated rows each give a row; other columns are not read.
    """
    model = model or fit(docs, id_col, text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = held(shared, lambda: shared.value)
        for batch in parts(batches):
            langs, sure, ok = learned.judge(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(sure, pa.float64()), pa.array(ok, pa.bool_())], names=["doc_id", "held_out", "lang_pred", "score", "accepted"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")


def keep_identified(docs: DataFrame, model: Model | None = None, text_col: str = "text") -> DataFrame:
    """The documents whose language is accepted, all columns as they are."""
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = held(shared, lambda: shared.value)
        for batch in parts(batches):
            yield batch.filter(pa.array(learned.judge(batch.column(at).to_pylist())[2], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
