"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The vocabulary file (JSON of the tokenizers library) is a parameter: a path that every executor
can read. Nothing is trained. Texts are mapped byte by byte to printable characters, split by the
vocabulary's pattern and merged; decoding reverses the byte table.

Defined cases: a null or empty text has no ids and decodes to no bytes; special-token strings in a
text are ordinary text; a character split over several tokens keeps the offsets of the whole
character in each of them and is put together again by decoding; repeated rows stay as they are;
an empty table gives an empty table. Only the named columns are read, so other columns may have
any name.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Characters that one call of the tokenizer gets, as its result takes over 100 bytes a token.
CHUNK_CHARS = 500_000
#: Parts whose ids a Python worker remembers, twice: beyond it starts anew, and takes over what is still in use.
REMEMBERED = 250_000
#: Rows whose ids are taken out of Arrow at once.
DECODED_ROWS = 100


def byte_table() -> dict[int, str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


@lru_cache(maxsize=4)
def _token_bytes(path: str) -> list[bytes]:
    """The bytes of each id."""
    back = {c: b for b, c in byte_table().items()}
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        known = all(c in back for c in token)
        out[i] = bytes(back[c] for c in token) if known else token.encode()
    return out


_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACES = re.compile(r"\s\s|^\s|\s\Z")


def parts(text: str) -> list[str]:
    """The text cut where no token can span; the single space before every part but the first is left out.

    A space is only ever the first character of a match or part of a run of white space, so a
    single space between two other characters begins a match. A single line break between two
    others is a match of its own; the part that it begins has no space before it.
    """
    return _CUT.split(text) if _SPACES.search(text) else text.replace("\n", " \n").split(" ")


def spelled(part: str) -> str:
    """A part that is not the first of its text, as it stands there."""
    return part if part[0] == "\n" else " " + part


class _Encoder:
    """Encodes texts part by part, each different part once while it is remembered.

    Ids and offsets are kept as the bytes of 32-bit numbers, so that a text's are one join.
    """

    def __init__(self, path: str, offsets: bool):
        self.tokenizer = _tokenizer(path)
        self.old: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}
        self.known: dict[str, bytes] = {}
        self.spans: dict[str, bytes] = {}
        self.offsets = offsets
        self.merge, self.characters = self.tokenizer.model.tokenize, byte_table()
        marks = self.tokenizer.encode_batch([".", ","], add_special_tokens=False)
        self.marks = {m: np.array(e.ids, np.int32).tobytes() for m, e in zip(".,", marks, strict=True)}

    def put(self, part: str, ids: np.ndarray, spans: np.ndarray) -> None:
        self.known[part] = ids.tobytes()
        if self.offsets:
            self.spans[part] = spans.tobytes()

    def plain(self, part: str) -> bool:
        """Whether a part is letters only, whose characters can be told from the bytes."""
        return part.isalpha() and (part.isascii() or not self.offsets and max(part) < "\u0250")

    def learn(self, new: list[str]) -> None:
        """Letters are one match with the space before them and go to the library's model at once.

        Of the others, parts that end in no white space are joined, as each ends where the next begins.
        """
        for x in filter(self.plain, new):
            tokens = self.merge((b" " + x.encode()).decode("latin-1").translate(self.characters))
            self.known[x] = struct.pack(f"={len(tokens)}i", *[t.id for t in tokens])
            if self.offsets:
                ends = np.cumsum([len(t.value) for t in tokens], dtype=np.int32)
                self.spans[x] = np.stack([ends - [len(t.value) for t in tokens], ends], axis=1).astype(np.int32).tobytes()
        new = [x for x in new if not self.plain(x)]
        several = [x for x in new if not x[-1].isspace()]
        single = [x for x in new if x[-1].isspace()]
        groups = [several[i : i + 500] for i in range(0, len(several), 500)] + [[x] for x in single]
        joined = self.tokenizer.encode_batch(["".join(map(spelled, g)) for g in groups], add_special_tokens=False)
        for group, e in zip(groups, joined, strict=True):
            ids, spans = np.array(e.ids, np.int32), np.array(e.offsets, np.int32).reshape(-1, 2)
            ends = np.cumsum([len(spelled(x)) for x in group])
            cuts = np.searchsorted(spans[:, 0], ends).tolist()
            first, start = 0, 0
            for x, last, end in zip(group, cuts, ends.tolist(), strict=True):
                self.put(x, ids[first:last], spans[first:last] - start if self.offsets else spans)
                first, start = last, end

    def group(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        cut = [parts(t) for t in texts]
        first = self.tokenizer.encode_batch([ps[0] for ps in cut], add_special_tokens=False)
        rest = [ps[1:] for ps in cut]
        if len(self.known) > REMEMBERED:
            self.old, self.known, self.spans = (self.known, self.spans), {}, {}
        known, spans = self.known, self.spans
        new = set().union(*rest).difference(known)
        again = new.intersection(self.old[0])
        for mine, before in zip((known, spans), self.old, strict=True):
            mine.update((x, before[x]) for x in again if x in before)
        new -= again
        ended = [p for p in new if len(p) > 1 and p[-1] in self.marks and p[-2].isalpha()]
        new.difference_update(ended)
        for p in {p[:-1] for p in ended} - known.keys():
            if p in self.old[0]:
                known[p] = self.old[0][p]
                if self.offsets:
                    spans[p] = self.old[1][p]
            else:
                new.add(p)
        self.learn(sorted(new))
        for p in ended:  # a full stop or comma after a letter is a match of its own
            known[p] = known[p[:-1]] + self.marks[p[-1]]
            if self.offsets:
                n = len(spelled(p))
                spans[p] = spans[p[:-1]] + np.array([n - 1, n], np.int32).tobytes()
        for start, ps in zip(first, rest, strict=True):
            ids = np.frombuffer(np.array(start.ids, np.int32).tobytes() + b"".join(map(known.__getitem__, ps)), np.int32)
            if not self.offsets:
                yield ids, None
                continue
            widths = [len(spelled(p)) for p in ps]
            origin = start.offsets[-1][1] if start.offsets else 0
            begins = np.cumsum([origin, *widths[:-1]], dtype=np.int32)[: len(ps)]
            counts = [len(known[p]) // 4 for p in ps]
            within = np.frombuffer(b"".join(map(spans.__getitem__, ps)), np.int32).reshape(-1, 2)
            head = np.array(start.offsets, np.int32).reshape(-1, 2)
            yield ids, np.concatenate([head, within + np.repeat(begins, counts)[:, None]])

    def __call__(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        waiting, size = [], 0
        for text in texts:
            waiting.append(text)
            size += len(text)
            if size > CHUNK_CHARS:
                yield from self.group(waiting)
                waiting, size = [], 0
        yield from self.group(waiting)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))


def encode(
    df: DataFrame,
    vocabulary: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    offsets: bool = True,
) -> DataFrame:
    """``keep`` plus ``ids`` and, if asked for, ``starts`` and ``ends`` in code points."""
    named = [df[c] for c in keep]
    schema = T.StructType([*df.select(*named).schema, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if offsets:
        schema.add("starts", T.ArrayType(T.IntegerType())).add("ends", T.ArrayType(T.IntegerType()))
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(vocabulary, offsets)
        for batch in batches:
            at, ids, spans, tokens = 0, [], [], 0

            def out(to):
                columns = [batch.column(i).slice(at, to - at) for i in range(width)] + [_lists(ids)]
                if offsets:
                    columns += [_lists([x[:, k] for x in spans]) for k in (0, 1)]
                return pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

            for k, (found, where) in enumerate(encoder([t or "" for t in batch.column(width).to_pylist()])):
                ids.append(found)
                spans.append(where)
                tokens += len(found)
                if tokens > 250_000:
                    yield out(k + 1)
                    at, ids, spans, tokens = k + 1, [], [], 0
            if ids:
                yield out(batch.num_rows)

    return df.select(*named, df[text].alias("__text")).mapInArrow(run, schema)


def decode(
    df: DataFrame, vocabulary: str, ids: str = "ids", into: str = "decoded", special: tuple[int, ...] = ()
) -> DataFrame:
    """All columns of ``df`` plus the decoded bytes; ``special`` ids give none. Null ids give none."""
    schema = T.StructType([*df.schema, T.StructField(into, T.BinaryType())])
    at = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = list(_token_bytes(vocabulary))
        table += [b""] * (max(special, default=-1) + 1 - len(table))
        lengths = np.array([len(x) for x in table])
        starts = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(table), np.uint8)
        lengths[list(special)] = 0
        for batch in batches:
            for start in range(0, batch.num_rows, DECODED_ROWS):
                some = batch.slice(start, DECODED_ROWS)
                column = some.column(at)
                values = column.flatten().to_numpy()  # of rows that are not null
                n = lengths[values]
                ends = np.concatenate([[0], np.cumsum(n)])
                where = np.repeat(starts[values] - ends[:-1], n) + np.arange(ends[-1])
                counts = np.array([k or 0 for k in column.value_lengths().to_pylist()], np.int64)
                cuts = ends[np.concatenate([[0], np.cumsum(counts)])].astype(np.int64)
                done = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(cuts), pa.py_buffer(data[where])])
                yield pa.RecordBatch.from_arrays([*some.columns, done.cast(pa.binary())], names=schema.fieldNames())

    return df.mapInArrow(run, schema)
