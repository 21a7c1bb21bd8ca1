"""Toxicity by compression distance.

Two zstandard dictionaries are trained by the library's own trainer: one on ordinary text, one on toxic text. A window is
a word of the running text with the spaces about it, or a stretch of a longer run (scripts without spaces, long tokens),
repeated so that the coder's fixed costs don't hide the difference. Its gain is the number of bytes by which the toxic
dictionary compresses it better, as a share of its length. As a toxic document is mostly ordinary text, the toxic
dictionary holds the ordinary one, at the same distance, and before it what its own training adds: then windows of
ordinary text have the same length under both, and a gain comes from toxic passages alone. Labels mark documents, not
passages, so the toxic samples are, of each toxic document, the windows that occur in a larger share of toxic than of
ordinary documents; those that the trainer leaves out of its dictionary are put before it.

Labelled rows that are not held out are divided by hash of the text: two thirds train the dictionaries, one third
calibrates. A document's features are its numbers of windows beyond each of five margins of gain; a logistic function of
them is fitted on the calibration rows, and shifted so that 0.5 is the threshold with the best F1 there.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import mapped, slices, whole_text

#: Most labelled documents of each class that training takes; of them, one part in CALIBRATE calibrates.
TRAIN_ROWS, CALIBRATE = 4000, 4
#: A window's length in bytes beyond which a run is cut, the step of such cuts, and the length that repeats fill.
LONG, STRIDE, WIDTH = 48, 24, 48
#: A window stands for toxic passages if at least this share of toxic documents hold it (3 at least), RATIO times the ordinary share.
SUPPORT, RATIO, MOST_WINDOWS = 0.01, 20.0, 4096
#: Most bytes of a training sample, most ordinary samples, and the dictionaries' sizes in bytes.
SAMPLE, ORDINARY_SAMPLES, TOXIC_SIZE, ORDINARY_SIZE = 4096, 4000, 4096, 16384
#: Least gains, as shares of a window's length.
MARGINS = (0.25, 0.3, 0.35, 0.4, 0.5)
KEPT_WINDOWS = 200_000

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class ToxicModel:
    """Contents of the dictionaries and the calibrated logistic function of log(1 + windows beyond each margin)."""

    toxic: bytes
    ordinary: bytes
    slopes: tuple[float, ...]
    offset: float

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.log1p(counts) @ np.array(self.slopes) + self.offset, -30, 30)))


def tokens(text: str) -> list[bytes]:
    """What stands between white space, in lower case."""
    return text.lower().encode().split()


def windows(token: bytes) -> list[bytes]:
    """The windows of a token: without ASCII marks at its ends, between spaces, cut if it is long. Marks alone have none."""
    word = token.strip(_MARKS)
    if not word:
        return []
    run = b" " + word + b" "
    return [run] if len(run) <= LONG else [run[i : i + LONG] for i in range(0, len(run) - STRIDE, STRIDE)]


def tiled(window: bytes) -> bytes:
    return window * max(2, -(-WIDTH // len(window)))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters.from_level(
        6, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False, min_match=3, search_log=9, hash_log=16, chain_log=16, window_log=18
    )
    d = zstandard.ZstdCompressionDict(content.rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=how)


def lengths(compressor: zstandard.ZstdCompressor, found: list[bytes]) -> np.ndarray:
    """Compressed length of each window."""
    out = compressor.multi_compress_to_buffer([tiled(w) for w in found])
    return np.array([len(out[i]) for i in range(len(out))], np.int64)


def trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """A dictionary that zstandard's trainer makes of the samples; of samples too few for it, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6, level=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


class Levels(dict):
    """For each token, the number of margins that the best of its windows reaches; ``learn`` adds tokens in one call."""

    def __init__(self, model: ToxicModel):
        super().__init__()
        self.ordinary, self.toxic = _compressor(model.ordinary), _compressor(model.toxic + model.ordinary)

    def learn(self, wanted: set[bytes]) -> None:
        if len(self) > KEPT_WINDOWS:
            self.clear()
        new = sorted(wanted.difference(self))
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            of = [windows(t) for t in part]
            flat = [w for ws in of for w in ws]
            if not flat:
                self.update(dict.fromkeys(part, 0))
                continue
            gain = (lengths(self.ordinary, flat) - lengths(self.toxic, flat)) / np.array([len(w) for w in flat])
            reach, at = np.searchsorted(np.array(MARGINS), gain + 1e-9, side="right").tolist(), 0
            for t, ws in zip(part, of):
                self[t] = max(reach[at : at + len(ws)], default=0)
                at += len(ws)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Numbers of tokens that reach each margin, one row for each text."""
        split = [tokens(t) for t in texts]
        self.learn(set().union(*split))
        out = np.zeros((len(texts), len(MARGINS)), np.int64)
        for row, words in zip(out, split):
            for level, n in Counter(map(self.__getitem__, words)).items():
                row[:level] += n
        return out


def held_out(doc_id="doc_id"):
    """Whether a document is kept from training; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic, weight): at most ``rows`` labelled documents of each class that aren't held out, distinct by text.

    Chosen by hash; weight tells how many labelled documents each one stands for. The ids are at most 2 * rows, so they
    are broadcast to the scan of the documents.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    order = F.xxhash64("doc_id")
    ids = known.where("toxic = 1").orderBy(order).limit(rows).union(known.where("toxic = 0").orderBy(order).limit(rows))
    weight = F.when(F.col("toxic") == 1, F.lit(max(1.0, total.get(1, 0) / rows))).otherwise(F.lit(max(1.0, total.get(0, 0) / rows)))
    return docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(ids), "doc_id").select("text", "toxic", weight.alias("weight")).groupBy("text", "toxic").agg(F.sum("weight").alias("weight"))


def unlike(train: DataFrame) -> DataFrame:
    """(text, toxic): of training texts that share the least hash of their word triples, as near copies do, one."""

    def run(batches):
        for b in (s for batch in batches for s in slices(batch)):
            keys = []
            for t in b.column(0).to_pylist():
                w = tokens(t)
                keys.append(min((xxhash.xxh64_intdigest(b" ".join(x)) for x in zip(w, w[1:], w[2:])), default=0) >> 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.int64())], names=["text", "toxic", "key"])

    rows = mapped(train.select("text", "toxic"), run, "text string, toxic int, key long")
    return rows.groupBy("key", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def toxic_windows(train: DataFrame) -> list[bytes]:
    """Windows that stand for toxic passages, by the training documents that hold them; at most MOST_WINDOWS."""

    def run(batches):
        for b in (s for batch in batches for s in slices(batch)):
            seen: Counter = Counter()
            for t, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen.update((w, toxic) for w in {w for x in set(tokens(t)) for w in windows(x)})
            keys = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.int32()), pa.array([seen[k] for k in keys], pa.int64())], names=["window", "toxic", "n"])

    n = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}  # two rows
    seen = mapped(train.select("text", "toxic"), run, "window binary, toxic int, n long").groupBy("window").agg(F.sum(F.col("n") * F.col("toxic")).alias("t"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("o"))
    share_t, share_o = F.col("t") / n[1], (F.col("o") + 0.5) / (n[0] + 1)
    rows = seen.where((F.col("t") >= max(3, SUPPORT * n[1])) & (share_t > RATIO * share_o)).orderBy(F.desc(share_t * F.log(share_t / share_o)), "window").limit(MOST_WINDOWS)
    return [bytes(r["window"]) for r in rows.select("window").collect()]


def samples(train: DataFrame, chosen: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Training samples: of each toxic document its chosen windows as they follow one another; pieces of ordinary text."""
    among = frozenset(chosen)

    def run(batches):
        for b in (s for batch in batches for s in slices(batch)):
            out, kind = [], []
            for t, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = tokens(t)
                if toxic:
                    raw = b"".join(w for x in words for w in windows(x) if w in among)
                else:
                    raw = b" ".join(words)
                parts = [raw[i : i + SAMPLE] for i in range(0, len(raw), SAMPLE)]
                out += parts
                kind += [toxic] * len(parts)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(kind, pa.int32())], names=["sample", "toxic"])

    found = mapped(train.select("text", "toxic"), run, "sample binary, toxic int")
    pick = lambda k: [bytes(r["sample"]) for r in found.where(F.col("toxic") == k).orderBy(F.xxhash64("sample"), "sample").limit(ORDINARY_SAMPLES).collect()]
    return pick(1), pick(0)


def fit(train: DataFrame) -> ToxicModel:
    """A model from (text, toxic, weight). Without rows of one class, or without windows that set toxic documents apart,
    every score is the share of toxic rows, smoothed, and at most 0.49."""
    train = train.select("text", "toxic", "weight", (F.pmod(F.xxhash64("text"), F.lit(CALIBRATE)) == 0).alias("calibrates")).cache()
    first = None
    try:
        sums = {(r["toxic"], r["calibrates"]): (r["n"], r["w"]) for r in train.groupBy("toxic", "calibrates").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect()}  # four rows
        w1, w0 = (sum(w for (toxic, _), (_, w) in sums.items() if toxic == k) for k in (1, 0))
        share = min(0.49, (w1 + 0.5) / (w1 + w0 + 2))
        none = ToxicModel(b"", b"", (0.0,) * len(MARGINS), math.log(share / (1 - share)))
        if (1, False) not in sums or (0, False) not in sums:
            return none
        first = unlike(train.where("NOT calibrates")).cache()
        chosen = toxic_windows(first)
        if not chosen:
            return none
        toxic, ordinary = samples(first, chosen)
        content = trained(toxic * 8, TOXIC_SIZE, 12)
        content = b"".join(w for w in chosen if w not in content)[:TOXIC_SIZE] + content
        model = ToxicModel(content, trained(ordinary, ORDINARY_SIZE, 32), none.slopes, none.offset)
        both = {k[0] for k in sums if k[1]} == {0, 1}
        rows = counted(train.where("calibrates") if both else train, model, ["toxic", "weight"]).collect()  # at most 2 * TRAIN_ROWS rows of a few numbers
        rows.sort(key=lambda r: (r["toxic"], r["weight"], r["reached"]))
        x, y, w = np.log1p(np.array([r["reached"] for r in rows], np.float64)), np.array([r["toxic"] for r in rows], np.float64), np.array([r["weight"] for r in rows])
        slopes, offset = logistic(x, y, w)
        return ToxicModel(model.toxic, model.ordinary, tuple(slopes), offset - best_cut(x @ slopes + offset, y, w))
    finally:
        train.unpersist()
        if first is not None:
            first.unpersist()


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Slopes and offset of a weighted logistic regression with a ridge on the slopes, by Newton's method."""
    z, w = np.c_[x, np.ones(len(x))], w / w.sum()
    b, keep = np.zeros(z.shape[1]), np.r_[np.ones(x.shape[1]), 1e-6]
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        step = np.linalg.solve((z * (w * (p * (1 - p) + 1e-9))[:, None]).T @ z + ridge * np.diag(keep), z.T @ (w * (p - y)) + ridge * keep * b)
        b -= np.clip(step, -4, 4)
    return b[:-1], float(b[-1])


def best_cut(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """The threshold on ``z`` with the best weighted F1, half way between the two values it divides."""
    values = np.unique(z)
    cuts = np.append((values[1:] + values[:-1]) / 2, values[-1] + 1)
    f1 = [2 * (hit := w[(z > c) & (y == 1)].sum()) / max(hit + w[y == 1].sum() + w[(z > c) & (y == 0)].sum(), 1e-12) for c in cuts]
    return float(cuts[int(np.argmax(f1))])


def counted(docs: DataFrame, model: ToxicModel, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``reached``: for each margin the number of windows of the whole text beyond it."""
    kept = docs.select(*keep, whole_text().alias("_text"))

    def run(batches):
        levels = Levels(model)
        for b in (s for batch in batches for s in slices(batch)):
            got = levels.counts(b.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got.tolist(), pa.list_(pa.int64()))], names=[*keep, "reached"])

    return mapped(kept, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]) + ", reached array<bigint>")


def with_score(docs: DataFrame, model: ToxicModel, keep: list[str]) -> DataFrame:
    """Columns ``keep``, then score (0 to 1) and predicted (1 from 0.5 on). The score depends on the text alone; a null
    text counts as empty. Repeated rows stay."""
    x = sum((F.log1p(F.col("reached")[i].cast("double")) * s for i, s in enumerate(model.slopes)), F.lit(model.offset))
    score = 1 / (1 + F.exp(-x))
    return counted(docs, model, keep).select(*keep, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``, from a model fitted on labels not held out."""
    model = fit(training_texts(docs, labels))
    return with_score(docs, model, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the model doesn't predict to be toxic, all columns kept."""
    model = fit(training_texts(docs, labels))
    columns = docs.columns
    names = [f"_c{i}" for i in range(len(columns))]  # a clash with score, predicted or reached can't happen
    inner = docs.toDF(*names)
    inner = inner.withColumn("text", F.col(names[columns.index("text")]))
    return with_score(inner, model, names).where("predicted = 0").select(*names).toDF(*columns)
