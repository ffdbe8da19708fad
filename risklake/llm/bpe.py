"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

The symbols of many words lie in one flat array. Every round looks the adjacent
pairs up by binary search over the sorted pair keys, finds each word's lowest
rank, and merges that pair wherever the word has it, until no pair is left.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risklake.llm.words import by_arrow, chunks

KEPT_WORDS = 400_000
_NONE = np.int64(1) << 40
LETTER, NUMBER, OTHER, SPACE, BLANK, EDGE = range(6)


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves; the others, in order, for
    the characters from 256 on.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    table = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class Vocabulary:
    """Merges and tokens of a byte-level BPE file, as arrays."""

    def __init__(self, definition: dict):
        model = definition["model"]
        ids: dict[str, int] = model["vocab"]
        chars = _byte_characters()
        self.byte_ids = np.array([ids[c] for c in chars], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([(ids[a] << 32) | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.special = {t["content"]: t["id"] for t in definition.get("added_tokens", [])}
        back = {c: b for b, c in enumerate(chars)}
        size = max([*ids.values(), *self.special.values()]) + 1
        tokens = [b""] * size
        for token, i in ids.items():
            tokens[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            tokens[i] = token.encode()
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_first = np.zeros(size + 1, np.int64)
        np.cumsum([len(t) for t in tokens], out=self.token_first[1:])

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the words, flat, and where each word's begin."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []
        while len(symbols):
            key = np.append((symbols[:-1] << 32) | symbols[1:], -1)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            hit[:-1] &= word[:-1] == word[1:]
            rank = np.where(hit, self.ranks[at], _NONE)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(word)))
            lowest = np.repeat(lowest, sizes)
            over = lowest == _NONE
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                symbols, word, rank, lowest = symbols[~over], word[~over], rank[~over], lowest[~over]
                if not len(symbols):
                    break
            chosen = rank == lowest
            # In a run of equal symbols every second pair overlaps the one before it.
            place = np.arange(len(chosen))
            starts = chosen & ~np.append(False, chosen[:-1])
            chosen &= (place - np.maximum.accumulate(np.where(starts, place, 0))) % 2 == 0
            symbols[chosen] = self.merged[rank[chosen]]
            keep = np.append(True, ~chosen[:-1])
            symbols, word = symbols[keep], word[keep]
        symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int64)
        word = np.concatenate(done_words) if done_words else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        firsts = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bincount(word, minlength=len(words)), out=firsts[1:])
        return symbols[order].astype(np.int32), firsts


def gather(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenation of values[start:start+length] for many ranges."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(start - (ends - length), length) + np.arange(total)]


_CLASSES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """Class of every code point, built once in a process."""
    if not _CLASSES:
        table = np.full(sys.maxunicode + 1, OTHER, np.int8)
        for cp in range(sys.maxunicode + 1):
            major = unicodedata.category(chr(cp))[0]
            if major in "LN":
                table[cp] = LETTER if major == "L" else NUMBER
        blanks = [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
        table[blanks] = BLANK
        table[32] = SPACE
        _CLASSES.append(table)
    return _CLASSES[0]


def pieces(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Cut texts into runs of letters, digits, other characters and blanks.

    One space goes with the run behind it; English contractions are pieces of
    their own. Returns the pieces and how many each text has.
    """
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    edges = np.cumsum(sizes) - 1
    kind = _classes()[points]
    kind[edges] = EDGE
    run = np.where(kind == BLANK, SPACE, kind)
    cut = np.append(True, (run[1:] != run[:-1]) | (run[1:] == EDGE))
    blank = run == SPACE
    text_next = np.append((run[1:] != SPACE) & (run[1:] != EDGE), False)
    last = blank & text_next
    cut |= last
    glued = np.append(False, last[:-1] & (kind[:-1] == SPACE))
    cut &= ~glued
    quotes = np.flatnonzero((points == 39) & cut & np.append(run[1:] == LETTER, False))
    if len(quotes):
        two, three = points[quotes + 1], points[np.minimum(quotes + 2, len(points) - 1)]
        short = np.isin(two, [ord(c) for c in "stmd"])
        long = np.zeros(len(quotes), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (two == ord(a)) & (three == ord(b))
        for at, n in ((quotes[short], 2), (quotes[long], 3)):
            cut[at + 1] = False
            inside = run[at + n] == LETTER
            cut[(at + n)[inside]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(points))
    real = run[starts] != EDGE
    found = [joined[a:b] for a, b in zip(starts[real].tolist(), ends[real].tolist(), strict=True)]
    return found, np.diff(np.searchsorted(starts[real], edges), prepend=0)


class Encoder:
    """Encodes texts; keeps the tokens of words seen, and forgets all beyond a number of them."""

    def __init__(self, vocabulary: Vocabulary, kept_words: int = KEPT_WORDS):
        self.vocabulary, self.kept_words = vocabulary, kept_words
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.pool = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.first, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _learn(self, words: list[str]) -> None:
        ids, firsts = self.vocabulary.merge([w.encode("utf-8", "surrogatepass") for w in words])
        while self.used + len(ids) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros_like(self.pool))
        n = len(self.rows)
        while n + len(words) > len(self.first):
            self.first, self.length = (np.append(x, np.zeros_like(x)) for x in (self.first, self.length))
        self.pool[self.used : self.used + len(ids)] = ids
        self.first[n : n + len(words)] = firsts[:-1] + self.used
        self.length[n : n + len(words)] = np.diff(firsts)
        self.used += len(ids)
        self.rows.update(zip(words, range(n, n + len(words)), strict=True))

    def plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without special tokens, flat, and how many each has."""
        words, counts = pieces(texts)
        if len(self.rows) > self.kept_words:
            self._forget()
        new = [w for w in dict.fromkeys(words) if w not in self.rows]
        if new:
            self._learn(new)
        row = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        length = self.length[row]
        ids = gather(self.pool, self.first[row], length)
        sums = np.append(0, np.cumsum(length))
        bounds = np.append(0, np.cumsum(counts))
        return ids, np.diff(sums[bounds])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``plain``; the strings of special tokens become their ids."""
        special = self.vocabulary.special
        if not any(s in t for s in special for t in texts):
            return self.plain(texts)
        parts, owner, marks = [], [], []
        for i, text in enumerate(texts):
            while True:
                found = min(((text.find(s), -len(s), s) for s in special if s in text), default=None)
                parts.append(text if found is None else text[: found[0]])
                owner.append(i)
                marks.append(-1 if found is None else special[found[2]])
                if found is None:
                    break
                text = text[found[0] + len(found[2]) :]
        ids, counts = self.plain(parts)
        behind = np.array(marks)
        ids = np.insert(ids, np.cumsum(counts)[behind >= 0], behind[behind >= 0])
        return ids, np.bincount(owner, weights=counts + (behind >= 0), minlength=len(texts)).astype(np.int64)


def decode(vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of flat ids; bytes that are not UTF-8 become the replacement character."""
    first = vocabulary.token_first
    length = first[ids + 1] - first[ids]
    data = gather(vocabulary.token_bytes, first[ids], length).tobytes()
    ends = np.append(0, np.cumsum(length))[np.append(0, np.cumsum(counts))].tolist()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _flat(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    lists = batch.column(column)
    counts = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` in place of it.

    NULL and empty texts have no tokens. Whole texts are encoded, a megabyte or
    one longer text at a time. The vocabulary file is read once on the driver and
    broadcast; its size does not depend on the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    others = [c for c in docs.columns if c not in (text, ids)]
    given = docs.select(*others, F.col(text).alias(ids))
    schema = docs.select(*others).schema.add(ids, T.ArrayType(T.IntegerType()))
    target = pa.list_(pa.int32())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(ids).to_pylist()]
            for a, b in chunks(map(len, texts)):
                flat, counts = encoder.encode(texts[a:b])
                offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())).cast(target)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in others), lists], names=[*others, ids]
                )

    return by_arrow(given, task, schema)


def decoded(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of its token ids in a further column (NULL ids: empty)."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    schema = docs.select("*").schema.add(text, "string")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(ids).offsets.to_numpy()) * 4
            for a, b in chunks(sizes.tolist()):
                part = batch.slice(a, b - a)
                flat, counts = _flat(part, ids)
                texts = decode(shared.value, flat, counts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, text]
                )

    return by_arrow(docs, task, schema)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of tokens, digests of the ids and of the text decoded from them."""
    both = decoded(encoded(docs.select("doc_id", "text"), path), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path())
