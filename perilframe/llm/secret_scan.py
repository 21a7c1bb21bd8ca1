"""Secret scans: base patterns, and a character convolutional network over every candidate and its context.

Candidates are all runs of 12 or more token characters, those inside base matches too. Each is seen through a window of
characters before, inside (its head and tail) and after it. The network (embedding, convolution, max pooling, one hidden
layer, in numpy) is trained on labelled findings: values of base matches of a bounded sample of documents, and findings
that the base patterns don't make, of public key formats (``FORMATS``) and of random values, put into the sample's own
contexts; against the sample's other candidates. It is trained twice, the second time with those of the sample's other
candidates that it took for findings at first. Its scores are calibrated on held-out findings (Platt); the threshold is the
highest that keeps the wanted recall there. Base spans always stay; a candidate that the network accepts and that is not inside
base spans is added as kind ``cnn``.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import mapped, slices, whole_text

# The base patterns and the least length of what they must match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "cnn")
#: Quick test for a text that can hold an assignment.
_KEYS = re.compile(r"passw|secret|token|api_?key", re.I | re.A)

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-][A-Za-z0-9+/_.=-]{11,}")
#: Most documents that training looks at, and most candidates of each class that it learns from.
TRAIN_DOCS, TRAIN_ROWS = 20_000, 3_000
BEFORE, HEAD, TAIL, AFTER = 16, 24, 8, 4
WIDTH = BEFORE + HEAD + TAIL + AFTER
RECALL = 0.98


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, by start and kind; leftmost and non-overlapping within a kind."""
    out = []
    if _KEYS.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, how) of all runs of token characters; how: 0 apart from base spans, 1 touching them, 2 inside them.

    One pass over both lists, which are sorted by start.
    """
    joined: list[list[int]] = []
    for s, _, e in spans:
        if joined and s <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], e)
        else:
            joined.append([s, e])
    out, i = [], 0
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        while i < len(joined) and joined[i][1] <= a:
            i += 1
        touches = i < len(joined) and joined[i][0] < b
        out.append((a, b, 2 if touches and joined[i][0] <= a and b <= joined[i][1] else int(touches)))
    return out


def window(text: str, start: int, end: int) -> str:
    """The fixed-length view of a candidate: context, head, tail, context, each filled with zero characters."""
    body = text[start:end]
    head, tail = body[:HEAD], body[HEAD:][-TAIL:]
    return text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0") + head.ljust(HEAD, "\0") + tail.ljust(TAIL, "\0") + text[end : end + AFTER].ljust(AFTER, "\0")


_CODE = np.full(256, 1, np.uint8)
_CODE[0] = 0
_CODE[32:127] = np.arange(2, 97)
SYMBOLS = 97


def codes(windows: list[str]) -> np.ndarray:
    """Symbols of the windows: printable ASCII, nothing, or other."""
    raw = "".join(windows).encode("latin-1", "replace").replace(b"\n", b" ")
    return _CODE[np.frombuffer(raw, np.uint8)].reshape(-1, WIDTH)


@dataclass
class CharCnn:
    """Weights; ``table`` holds, for each place in a filter and each symbol, what it adds to the filters."""

    embed: np.ndarray  # SYMBOLS x E
    kernel: np.ndarray  # K x E x C
    shift: np.ndarray  # C
    place: np.ndarray  # regions x C: a filter's response also depends on context, head, tail
    hidden: np.ndarray
    hidden_shift: np.ndarray
    out: np.ndarray
    out_shift: float
    scale: float = 1.0
    offset: float = 0.0
    threshold: float = 0.5

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i : i + 1024])[-1] for i in range(0, len(x), 1024)]) if len(x) else np.zeros(0)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(x) + self.offset, -30, 30)))

    def _forward(self, x: np.ndarray):
        k = len(self.kernel)
        e = self.embed[x]
        wide = np.lib.stride_tricks.sliding_window_view(e, k, axis=1).transpose(0, 1, 3, 2).reshape(len(x), WIDTH - k + 1, -1)
        conv = wide @ self.kernel.reshape(-1, self.kernel.shape[2]) + self.shift
        pooled, at = [], []
        for a, b in REGIONS:
            part = conv[:, a : min(b, conv.shape[1])]
            top = part.argmax(1)
            at.append(top + a)
            pooled.append(np.take_along_axis(part, top[:, None], 1)[:, 0])
        pool = np.maximum(np.concatenate(pooled, 1), 0)
        hid = np.maximum(pool @ self.hidden + self.hidden_shift, 0)
        return wide, at, pool, hid, hid @ self.out + self.out_shift


REGIONS = ((0, BEFORE), (BEFORE, BEFORE + HEAD), (BEFORE + HEAD, WIDTH))


def train(x: np.ndarray, y: np.ndarray, seed: int = 7, epochs: int = 10, e: int = 6, k: int = 5, c: int = 12, h: int = 16) -> CharCnn:
    """A network fitted to windows ``x`` and labels ``y`` by Adam on log loss; deterministic."""
    rng = np.random.default_rng(seed)
    f = np.float32
    net = CharCnn(rng.normal(0, 0.5, (SYMBOLS, e)).astype(f), rng.normal(0, 0.3, (k, e, c)).astype(f), np.zeros(c, f), np.zeros((3, c), f), rng.normal(0, 0.3, (3 * c, h)).astype(f), np.zeros(h, f), rng.normal(0, 0.3, h).astype(f), 0.0)
    names = ["embed", "kernel", "shift", "hidden", "hidden_shift", "out", "out_shift"]
    m = {n: np.zeros_like(np.asarray(getattr(net, n), np.float64)) for n in names}
    v = {n: np.zeros_like(z) for n, z in m.items()}
    step = 0
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)).astype(f)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 128):
            b = order[i : i + 128]
            wide, at, pool, hid, z = net._forward(x[b])
            d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[b]) * weight[b] / len(b)
            g = {"out": hid.T @ d, "out_shift": d.sum()}
            dh = d[:, None] * net.out * (hid > 0)
            g["hidden"], g["hidden_shift"] = pool.T @ dh, dh.sum(0)
            dp = (dh @ net.hidden.T) * (pool > 0)
            rows = np.arange(len(b))[:, None]
            gk, ge = np.zeros((k * e, c)), np.zeros_like(m["embed"])
            for r, top in enumerate(at):
                part = dp[:, r * c : (r + 1) * c]
                seen = wide[rows, top]  # batch x c x k*e
                gk += np.einsum("bcx,bc->xc", seen, part)
                back = part[:, :, None] * net.kernel.reshape(-1, c).T
                for j in range(k):
                    np.add.at(ge, x[b][rows, top + j], back[:, :, j * e : (j + 1) * e])
            g["kernel"], g["embed"], g["shift"] = gk.reshape(k, e, c), ge, sum(dp[:, r * c : (r + 1) * c] for r in range(3)).sum(0)
            step += 1
            for n in names:
                m[n] = 0.9 * m[n] + 0.1 * g[n]
                v[n] = 0.999 * v[n] + 0.001 * g[n] ** 2
                now = getattr(net, n) - 0.01 * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, now.astype(f) if n != "out_shift" else float(now))
    return net


def calibrate(net: CharCnn, x: np.ndarray, y: np.ndarray, recall: float = RECALL) -> CharCnn:
    """Platt scaling on held-out candidates, then the highest threshold with the wanted recall; 0.5 without findings."""
    z = net.logits(x)
    a, b = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        a, b = a - 0.05 * (((p - y) * z).mean() + 1e-3 * a), b - 0.05 * (p - y).mean()
    net.scale, net.offset = float(max(a, 1e-3)), float(b)
    p = np.sort(net.probabilities(x[y == 1]))
    net.threshold = float(p[int((1 - recall) * len(p))]) if len(p) else 0.5
    return net


_HEX, _BASE = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
# Public key formats, as prefix, alphabet and number of characters.
FORMATS = (
    ("ghp_", _BASE, 36), ("github_pat_", _BASE + "_", 60), ("glpat-", _BASE + "-_", 20), ("xoxb-", "0123456789-" + _BASE, 48), ("sk_live_", _BASE, 24),
    ("AIza", _BASE + "-_", 35), ("ya29.", _BASE + "-_", 60), ("eyJ", _BASE + "-_", 60), ("SG.", _BASE + "-_", 60), ("npm_", _BASE, 36), ("ASIA", _BASE[:26] + "234567", 16),
)


def planted(context: str, rng: random.Random) -> str:
    """A window with a finding that the base patterns don't make, behind the end of ``context``."""
    if rng.random() < 0.4:
        prefix, alphabet, size = rng.choice(FORMATS)
    else:
        prefix, alphabet = "", rng.choice([_HEX.upper(), _BASE, _BASE, _BASE + "+/", _BASE + "_-", _BASE[:26] + "0123456789"])
        size = rng.choice([16, 20, 24, 32, 40, 48, 64])
    value = prefix + "".join(rng.choice(alphabet) for _ in range(size))
    if not (any(ch.isdigit() for ch in value) and any(ch.isalpha() for ch in value)):
        value = value[:-2] + "7" + alphabet[10]
    key = rng.choice(["key", "auth", "pwd", "private_key", "client_id", "access", "Bearer", "sig", "credential", "Authorization", "", ""])
    joint = rng.choice([" = ", "=", ": ", ":", " ", '="', ' = "', "': '"]) if key else " "
    made = context + key + joint
    return window(made + value + rng.choice([" ", "\n", '"', "'", ",", ""]), len(made), len(made) + len(value))


def seen_in(docs: DataFrame) -> DataFrame:
    """(seen, label) of the distinct candidates of whole texts: 1 for values of base matches, 0 for those apart from them."""

    def run(batches):
        for b in (s for batch in batches for s in slices(batch)):
            rows = []
            for t in b.column(0).to_pylist():
                spans = base_spans(t)
                for s, kind, e in spans:
                    if kind == 0:  # the network sees the value, as it does for other candidates
                        s = ASSIGN.match(t, s).start(2)
                    rows.append((window(t, s, e), 1))
                rows += [(window(t, s, e), 0) for s, e, how in candidates(t, spans) if how == 0]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], names=["seen", "label"])

    return mapped(docs.select(whole_text().alias("text")), run, "seen string, label int").distinct()


def mistaken(found: DataFrame, net: CharCnn) -> DataFrame:
    """The candidates labelled 0 that the network takes for findings."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(net.probabilities(codes(b.column(0).to_pylist())) >= net.threshold))

    return mapped(found.where("label = 0").select("seen"), run, "seen string")


def fit(docs: DataFrame, most_docs: int = TRAIN_DOCS, most_rows: int = TRAIN_ROWS) -> CharCnn:
    """A calibrated network from a sample of at most ``most_docs`` documents, chosen by hash of doc_id.

    The sample's ids are broadcast to one scan; its candidates (at most ``most_rows`` of each class, by hash, and as many
    mistaken ones) come to the driver as short windows. Without any finding in the sample, planted ones alone stand for the class.
    """
    order = F.xxhash64("doc_id")
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(order, "doc_id").limit(most_docs)
    found = seen_in(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")).cache()
    try:
        pick = lambda df: [r["seen"] for r in df.orderBy(F.xxhash64("seen"), "seen").limit(most_rows).collect()]
        positive, negative = pick(found.where("label = 1")), pick(found.where("label = 0"))
        hard = pick(mistaken(found, learned(positive, negative)))
        return learned(positive, list(dict.fromkeys(negative + hard)))
    finally:
        found.unpersist()


def learned(positive: list[str], negative: list[str], seed: int = 7, recall: float = RECALL) -> CharCnn:
    """Trains on four fifths of the windows and of as many planted findings (600 at least), calibrates on the rest."""
    rng = random.Random(seed)
    source = [p[:BEFORE].strip("\0") for p in positive + negative[:500]] or [""]
    made = [planted(rng.choice(source) + " ", rng) for _ in range(max(600, len(positive)))]
    words = negative or ["\0" * BEFORE + "x" * (HEAD + TAIL) + "\0" * AFTER]
    x, y = codes(positive + made + words), np.array([1] * (len(positive) + len(made)) + [0] * len(words))
    order = np.random.default_rng(seed).permutation(len(x))
    cut = len(x) * 4 // 5
    net = train(x[order[:cut]], y[order[:cut]])
    return calibrate(net, x[order[cut:]], y[order[cut:]], recall)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


NAMES = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def all_spans(texts: list[str], net: CharCnn):
    """For each text its base spans, and those with the spans that the network adds."""
    base = [base_spans(t) for t in texts]
    more = [candidates(t, s) for t, s in zip(texts, base)]
    seen = [window(t, a, b) for t, c in zip(texts, more) for a, b, _ in c]
    yes = (net.probabilities(codes(seen)) >= net.threshold).tolist() if seen else []
    at = 0
    for s, c in zip(base, more):
        added = [(a, 3, b) for (a, b, how), ok in zip(c, yes[at : at + len(c)]) if ok and how < 2]
        at += len(c)
        yield s, sorted(s + added) if added else s


def scanned(docs: DataFrame, net: CharCnn) -> DataFrame:
    """Counts and spans of secrets in every whole text (columns as in ``SCHEMA``); null counts as empty.

    Repeated rows stay, other columns are not looked at; one narrow pass over texts in pieces.
    """

    def run(batches):
        for b in (s for batch in batches for s in slices(batch)):
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i in range(0, len(texts), 200):
                rows = []
                for doc, (base, every) in zip(ids[i : i + 200], all_spans(texts[i : i + 200], net)):
                    rows.append((doc, *(sum(k == kind for _, k, _ in base) for kind in range(3)), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=NAMES)

    return mapped(docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")), run, SCHEMA)


def redacted(docs: DataFrame, net: CharCnn, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret of ``text`` replaced by a mark (overlapping spans by one); other columns as they are."""
    at = docs.columns.index("text")

    def run(batches):
        for b in (s for batch in batches for s in slices(batch)):
            texts = b.column(at).to_pylist()
            out = []
            for i in range(0, len(texts), 200):
                part = [t or "" for t in texts[i : i + 200]]
                for t, (_, spans), old in zip(part, all_spans(part, net), texts[i : i + 200]):
                    done, parts = 0, []
                    for s, _, e in spans:
                        if s >= done:
                            parts += [t[done:s], mark]
                        done = max(done, e)
                    out.append("".join([*parts, t[done:]]) if spans else old)
            columns = list(b.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return mapped(docs, run, docs.schema)
