"""Packing by concatenate and cut (operator 1).

Two passes.  The first turns every document into token ids (plus an end id) and
writes them with their partition number and the tokens before them in that
partition.  A prefix sum over the partition totals, one row per partition, gives
each document its global offset.  The second pass cuts the ids at the fixed
window boundaries; a document that crosses one yields a piece on either side.
Nothing is shuffled but the partition totals.

Any vocabulary file of the tokenizers library may be given.

Defined results: null or empty text is the end id alone; very long texts are
turned into ids on their own, whole, and cut like others; repeated rows are
documents of their own; an empty table gives no pieces; null ids stay null;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepipe.llm.common import written
from tablepipe.llm.texts import pieces, slim, words

SEQUENCE = 2048
END_ID = 1
# Bytes of text that a task turns into ids together, if a single text is not longer.
# Places, words and ids held beside it are many times as large, so pieces are small.
PIECE = 2 << 20
# Distinct words a task keeps with their ids before it starts afresh.
CACHE_WORDS = 600_000
# Words that go to the tokenizer as one text.
JOINED = 5_000
# A split whose words can be cut further: letters, single digits and other signs
# never meet in one piece, but after an apostrophe.
LETTERS_DIGITS_SIGNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Steps of a tokenizer file after which a text's ids are those of its words in turn.
CHARACTER_STEPS = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents"}
WORD_SPLITS = {"WhitespaceSplit", "Whitespace", "BertPreTokenizer"}


def _steps(step: dict | None, inner: str) -> list[dict]:
    return [] if step is None else step[inner] if step["type"] == "Sequence" else [step]


def word_by_word(config: dict) -> bool:
    """Whether a tokenizer file drops white space and never joins across it, as
    its own normaliser and splitter say: characters are changed one by one (or
    runs of white space become one space), then a split keeps no white space."""
    for step in _steps(config.get("normalizer"), "normalizers"):
        spaces = step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"} and step["content"] == " "
        if step["type"] not in CHARACTER_STEPS and not spaces:
            return False
    splits = _steps(config.get("pre_tokenizer"), "pretokenizers")
    if config.get("truncation") or config.get("padding") or config.get("post_processor") or not splits:
        return False
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) for t in config.get("added_tokens", [])):
        return False
    first = splits[0]
    if first["type"] in WORD_SPLITS:
        return True
    if first["type"] != "Split" or first["behavior"] != "Removed" or not first["invert"]:
        return False
    # Only what the pattern matches is kept: no alternative of it may match white space.
    import regex

    pattern = regex.compile(first["pattern"].get("Regex", regex.escape(first["pattern"].get("String", ""))))
    blanks = [chr(c) for c in (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
    probes = ["a{0}b", "{0}", "1{0}2", ".{0}!", "'{0}s", "{0}{0}x"]
    return not any(any(c.isspace() for c in m.group()) for b in blanks for p in probes for m in pattern.finditer(p.format(b)))


def byte_classes(config: dict) -> np.ndarray | None:
    """Classes of ASCII letters (1), digits (2) and signs (3) between which a word
    may be cut for this file, or None.  Apostrophes and signs that occur in an
    added token stay with what is beside them (0)."""
    first = _steps(config.get("pre_tokenizer"), "pretokenizers")[0]
    if first.get("pattern") != {"Regex": LETTERS_DIGITS_SIGNS}:
        return None
    whole = {"'"} | {c for t in config.get("added_tokens", []) for c in t["content"] if not c.isalnum()}
    kinds = [0 if not 33 <= b < 127 or chr(b) in whole else 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3 for b in range(256)]
    return np.asarray(kinds, np.uint8)


class Coder:
    """Ids of texts by the vocabulary file at ``path``.

    Where the file allows it (``word_by_word``) every distinct word of a batch
    goes to the tokenizer once and the texts are put together from the words'
    ids; else whole texts go to the tokenizer."""

    def __init__(self, path: str, end_id: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.by_word = word_by_word(config)
        self.classes = byte_classes(config) if self.by_word else None
        self.lower = any(x["type"] == "Lowercase" for x in _steps(config.get("normalizer"), "normalizers"))
        self.added = [t["content"] for t in config.get("added_tokens", [])]
        self.signs = {"".join(itertools.takewhile(lambda c: not c.isalpha(), a)) for a in self.added}  # how they begin, in any case
        self.end = [] if end_id is None else [end_id]
        self.clear()

    def clear(self) -> None:
        """Word 0 is the end of a text."""
        self.number: dict[bytes, int] = {}
        self.flat = np.asarray(self.end, "<u4")
        self.size = np.asarray([len(self.end)], np.int64)

    def _numbers(self, distinct: list[bytes]) -> np.ndarray:
        new = [w for w in distinct if w not in self.number]
        if new and len(self.number) + len(new) > CACHE_WORDS:
            self.clear()
            new = distinct
        if new:
            if self.classes is not None:
                # Small ASCII letters are left alone by every step before the merges.
                merge, simple = self.tokenizer.model.tokenize, [w.isalpha() and w.islower() for w in new]
                others = iter(self._encoded([w.decode() for w, s in zip(new, simple) if not s]))
                ids = [[t.id for t in merge(w.decode())] if s else next(others) for w, s in zip(new, simple)]
            else:
                ids = self._encoded([w.decode() for w in new])
            base = len(self.size)
            self.number.update(zip(new, range(base, base + len(new))))
            self.size = np.concatenate([self.size, np.fromiter(map(len, ids), np.int64, len(ids))])
            self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), "<u4")])
        return np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))

    def _encoded(self, new: list[str]) -> list[list[int]]:
        """The ids of each word.  Many words are one text for the tokenizer, with an
        added token between any two of them to tell their ids apart."""
        odd = {k for k, w in enumerate(new) if any(a in w for a in self.added)}
        if not self.added or odd:
            alone = iter([e.ids for e in self.encode([w for k, w in enumerate(new) if not self.added or k in odd], add_special_tokens=False)])
            if not self.added:
                return list(alone)
            others = iter(self._encoded([w for k, w in enumerate(new) if k not in odd]))
            return [next(alone) if k in odd else next(others) for k in range(len(new))]
        out: list[list[int]] = []
        between = self.tokenizer.token_to_id(self.added[0])
        texts = [f" {self.added[0]} ".join(new[k : k + JOINED]) for k in range(0, len(new), JOINED)]
        for found in self.encode(texts, add_special_tokens=False) if texts else ():
            ids = np.asarray(found.ids, np.int64)
            cuts = np.flatnonzero(ids == between)
            ends = [*cuts.tolist(), len(ids)]
            flat, at = ids.tolist(), 0
            for end in ends:
                out.append(flat[at:end])
                at = end + 1
        return out

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, number of ids of each text)."""
        if not self.by_word:
            found = [e.ids + self.end for e in self.encode([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return np.fromiter((i for x in found for i in x), "<u4"), np.fromiter(map(len, found), np.int64, len(found))
        # An added token is found before letters become small, so texts that may hold one keep theirs.
        plain = all(self.signs) and not any(pc.any(pc.match_substring(texts, a)).as_py() for a in self.signs)
        split, counts = words(texts, self.classes, self.lower and plain)
        coded = split.dictionary_encode()
        numbers = self._numbers(coded.dictionary.to_pylist())
        row = numbers[coded.indices.to_numpy(zero_copy_only=False)] if len(split) else np.zeros(0, np.int64)
        row = np.insert(row, np.cumsum(counts), 0)  # the end of every text
        starts = np.cumsum(self.size) - self.size
        size = self.size[row]
        upto = np.cumsum(size)
        total = int(upto[-1]) if len(upto) else 0
        kind = np.int32 if max(total, len(self.flat)) < 1 << 31 else np.int64
        at = np.repeat((starts[row] - (upto - size)).astype(kind), size)
        at += np.arange(total, dtype=kind)
        last = np.cumsum(counts + 1) - 1
        return self.flat[at], np.diff(upto[last], prepend=0)


def tokenized(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int | None = END_ID) -> DataFrame:
    """doc_id, ids (32-bit little-endian), tokens, part and the tokens before it in its part; written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, before = Coder(tokenizer, end_id), TaskContext.get().partitionId(), 0
        for some in pieces(batches, 1, PIECE):
            ids, n = coder.ids(some.column(1))
            ends = np.concatenate([[0], np.cumsum(n)])
            raw = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(4 * ends), pa.py_buffer(np.ascontiguousarray(ids))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [some.column(0), raw, pa.array(n), pa.array(np.full(len(n), part, np.int64)), pa.array(before + ends[:-1])],
                names=["doc_id", "ids", "tokens", "part", "before"],
            )
            before += int(ends[-1])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(slim(run), f"doc_id {kind}, ids binary, tokens long, part long, before long"), "tokens")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (32-bit little-endian),
    doc_tokens, sequence_id, offset.  All sequences but the last are full."""
    tokens = tokenized(docs, id_col, text_col, tokenizer, end_id)
    totals = tokens.groupBy("part").agg(F.sum("tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                rows, start, length, piece, total, seq, off = [], [], [], [], [], [], []
                for row, (raw, first) in enumerate(zip(some.column(1), some.column(2).to_pylist(), strict=True)):
                    ids = raw.as_py()
                    n, at = len(ids) // 4, 0
                    while at < n:
                        window, offset = divmod(first + at, sequence)
                        take = min(n - at, sequence - offset)
                        rows.append(row)
                        start.append(at)
                        length.append(take)
                        piece.append(ids[4 * at : 4 * (at + take)])
                        total.append(n)
                        seq.append(window)
                        off.append(offset)
                        at += take
                longs = [pa.array(x, pa.int64()) for x in (start, length, total, seq, off)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(rows, pa.int64())), longs[0], longs[1], pa.array(piece, pa.binary()), *longs[2:]],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

    # One row of two longs per partition of the input: the broadcast is bounded by the partition count.
    placed = tokens.join(F.broadcast(bases), "part").select("doc_id", "ids", (F.col("base") + F.col("before")).alias("first"))
    kind = tokens.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(slim(cut), f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum of their ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
