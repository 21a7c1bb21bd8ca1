"""BPE encoding and decoding over a prefix-sharing trie.

Distinct words of a batch go into a trie. A depth-first walk gives each node the last token of its prefix's encoding:
the one token ending there that fits behind the last token of the prefix before it. Two tokens fit if merging their
joined symbols gives just these two. So an encoding is a chain of last tokens, and shared prefixes are encoded once.
A word's final symbol carries the word-end mark and is a branch of its own.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import sys
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import mapped, slices, whole_text

#: Distinct words whose encodings a Python worker keeps between batches: after so many a new generation begins, and of
#: the last one only what is met again goes on, so frequent words are encoded once.
KEPT_WORDS = 200_000
#: Token pairs whose fit it keeps, and a rank beyond all.
KEPT_PAIRS, NEVER = 200_000, 1 << 60


def default_tokenizer() -> str:
    """The path of the public tokenizer file that the registered query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# What the tokenizers library's Unicode tables hold beyond those of Python's unicodedata 15.1. Its character
# classes are of Unicode 16 and its lower case of Unicode 17; its normal forms are those of unicodedata.
LATER_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
LATER_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
LATER_LOWER = (
    {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B}
    | {c: c + 0x20 for c in range(0x10D50, 0x10D66)}
    | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
)


def byte_symbols() -> list[str]:
    """A printable character for each byte: itself where it is printable Latin-1, else the next free one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in own else next(free)) for b in range(256)]


def _class(kind: str, later: tuple) -> str:
    """A character class body with all characters of a general category, and ``later`` ones."""
    spans, start = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == kind
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            spans.append((start, c - 1))
            start = None
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in [*spans, *later])


class TrieBpe:
    """Encodes and decodes with a word-end BPE vocabulary (normalised by NFC and lower case)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        model = j["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        letters, numbers = _class("L", LATER_LETTERS), _class("N", LATER_NUMBERS)
        space = "\t-\r\x20\x85\xa0  -     　"
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+")
        # the same, and much faster, for texts without numbers other than decimal digits, \x1c to \x1f and later characters
        self.usual_words = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
        self.unusual = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c in "\x1c\x1d\x1e\x1f" or unicodedata.category(c) in ("No", "Nl"))
        self.unusual |= {chr(c) for a, b in (*LATER_LETTERS, *LATER_NUMBERS) for c in range(a, b + 1)} | set(map(chr, LATER_LOWER))
        self.plain_words = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r\x20a-z0-9]+")
        self.symbols = byte_symbols()
        self.longest = max(len(self.units(t)) for t in self.vocab)
        self.token_of = {str(i): t for t, i in (self.vocab | self.special).items()}
        self.ids: dict[str, int] = {}
        self.fits: dict[str, bool] = {}
        self.cache: dict[str, tuple[str, int]] = {}
        self.older: dict[str, tuple[str, int]] = {}

    def units(self, token: str) -> list[str]:
        """The symbols of a token: characters, the last one with the word-end mark if the token has it."""
        if token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def merged(self, units: list[str]) -> list[str]:
        """Plain BPE: join the pair of least rank, leftmost first, until none is left."""
        rank = self.rank.get
        ranks = [rank(p, NEVER) for p in zip(units, units[1:])]
        while ranks and (least := min(ranks)) < NEVER:
            i = ranks.index(least)
            units[i : i + 2] = [units[i] + units[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((units[i - 1], units[i]), NEVER)
            if i < len(ranks):
                ranks[i] = rank((units[i], units[i + 1]), NEVER)
        return units

    def _usable(self, token: str) -> int:
        """The id of a token that its own symbols merge to, else -1."""
        got = self.ids[token] = self.vocab[token] if token in self.vocab and self.merged(self.units(token)) == [token] else -1
        return got

    def last(self, tail: str, depth: int, lasts: list[str], final: bool) -> str:
        """The last token of the encoding of a prefix of ``depth`` symbols that ends with ``tail``, the whole prefix or as
        many symbols as the longest token has. lasts: those of the prefix's own prefixes, by length; lasts[0] is empty."""
        n, word = len(tail), tail + self.end if final else tail
        vocab, usable, fits = self.vocab, self.ids, self.fits
        if n == depth and word in vocab and (usable[word] if word in usable else self._usable(word)) >= 0:
            return word
        for k in range(n - 1, -(depth > n), -1):  # only one token fits, and it is mostly a short one
            token = word[k:]
            if token not in vocab or (usable[token] if token in usable else self._usable(token)) < 0:
                continue
            before = lasts[depth - n + k]
            pair = before + " " + token
            ok = fits.get(pair)
            if ok is None:
                if len(fits) > KEPT_PAIRS:
                    fits.clear()
                ok = fits[pair] = self.merged(self.units(before) + self.units(token)) == [before, token]
            if ok:
                return token
        raise ValueError(f"no token of the vocabulary ends {tail[-20:]!r}")

    def _keep(self, word: str, tail: str, depth: int, lasts: list[str]) -> None:
        """Follows the chain of last tokens back from a word's end and caches its encoding."""
        tokens = [self.last(tail, depth, lasts, True)]
        n = depth - len(tokens[0]) + len(self.end)
        while n:
            tokens.append(lasts[n])
            n -= len(lasts[n])
        self.cache[word] = (" ".join([str(self.vocab[t]) for t in reversed(tokens)]), len(tokens))

    def learn(self, words: dict[str, str]) -> None:
        """Adds the encodings of distinct words to the cache, by one walk over the trie of their byte symbols (the keys).

        In sorted order words come as the walk meets them: a word's way down starts at the node where it leaves the word before, and lasts
        holds the states of all nodes above. A node keeps no more than its last symbols, as many as the longest token has, so the walk
        is linear in the words' length.
        """
        lasts = [""] * max(map(len, words), default=0)
        most, last, before = self.longest, self.last, ""
        for w in sorted(words):
            shared = 0  # the nodes of both words: prefixes shorter than either
            for a, b in zip(w[:-1], before[:-1]):
                if a != b:
                    break
                shared += 1
            n = len(w)
            for depth in range(shared + 1, n):
                lasts[depth] = last(w[depth - most if depth > most else 0 : depth], depth, lasts, False)
            self._keep(words[w], w[-most:], n, lasts)
            before = w

    def split(self, text: str) -> list[str]:
        """Words of a text, and special tokens as they stand."""
        out = []
        for i, part in enumerate(self.at_special.split(text) if "<|" in text else (text,)):
            if i % 2:
                out.append(part)
            elif part.isascii():
                out += self.plain_words.findall(part.lower())
            else:
                part = unicodedata.normalize("NFC", part)
                # one by one: a final sigma is a matter of context, which this vocabulary's lower-casing leaves out
                usual = self.unusual.isdisjoint(part)
                part = "".join([c.lower() for c in part]) if "\u03a3" in part else part.lower()
                out += self.usual_words.findall(part) if usual else self.words.findall(part.translate(LATER_LOWER))
        return out

    def encode_batch(self, texts: list[str]) -> list[tuple[str, int]]:
        """For each text its ids, joined by one space, and their number."""
        split = [self.split(t) for t in texts]
        if len(self.cache) > KEPT_WORDS:
            self.cache, self.older = {}, self.cache
        new, older = set().union(*split).difference(self.cache), self.older
        if older:
            met = new & older.keys()
            self.cache.update({w: older[w] for w in met})
            new -= met
        for s in new & self.special.keys():
            self.cache[s] = (str(self.special[s]), 1)
        symbols = self.symbols
        self.learn({w if w.isalpha() and w.isascii() else "".join([symbols[b] for b in w.encode()]): w for w in new - self.special.keys()})
        get, out = self.cache.__getitem__, []
        for words in split:
            if words:
                ids, n = zip(*map(get, words))
                out.append((" ".join(ids), sum(n)))
            else:
                out.append(("", 0))
        return out

    def decode(self, ids: str) -> str:
        """The text of ids that are joined by one space: their tokens, joined likewise; unknown ids have none."""
        try:
            return " ".join(map(self.token_of.__getitem__, ids.split(" "))) if ids else ""
        except KeyError:
            return " ".join([self.token_of[i] for i in ids.split(" ") if i in self.token_of])


@lru_cache(1)
def tokenizer(path: str) -> TrieBpe:
    return TrieBpe(path)


def encoded(docs: DataFrame, path: str | None = None, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text, and with ``ids`` the token_ids array.

    The decoded text is made of the ids. A null text counts as empty and has no tokens. Rows stay as they are, repeated
    ones too; one narrow pass.
    """
    path = path or default_tokenizer()

    def run(batches):
        gc.disable()  # the cache holds no cycles, and walking it costs a fifth of the time
        try:
            yield from coded(batches)
        finally:
            gc.enable()

    def coded(batches):
        bpe = tokenizer(path)
        for batch in batches:
            for b in slices(batch):
                got = bpe.encode_batch(b.column(1).to_pylist())
                cols = [b.column(0), pa.array([n for _, n in got], pa.int64())]
                cols += [pa.array([hashlib.sha256(f(x).encode()).hexdigest() for x, _ in got], pa.string()) for f in (str, bpe.decode)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    cols.append(pa.array([[int(i) for i in x.split()] for x, _ in got], pa.list_(pa.int32())))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * ids
    return mapped(docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")), run, schema)


def decoded(coded: DataFrame, path: str | None = None, ids: str = "token_ids") -> DataFrame:
    """Adds ``text`` (replaced if it is there), decoded from the array of ids in column ``ids``; null ids and arrays: as if absent."""
    path = path or default_tokenizer()
    kept = coded.drop("text") if ids != "text" else coded
    at = kept.columns.index(ids)

    def run(batches):
        bpe = tokenizer(path)
        for b in batches:
            texts = [bpe.decode(" ".join([str(i) for i in x or () if i is not None])) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, "text"])

    return mapped(kept, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", text string")
