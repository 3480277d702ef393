"""Token ids of whole texts by a public byte-level BPE, with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import functools
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidelake.sources.sink import open_read

RANK_FILE = os.environ.get("TIDELAKE_RANK_FILE", "/opt/tokenizers/byte_bpe_50k.tiktoken")

# Fixed value: the pre-splitting pattern of the byte_bpe_50k vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters after which a text may be cut at the next safe place, and the least run of white space that is taken out.
CHUNK = 20_000
LONG_BLANK = 500

# White space as \s of PATTERN means it (the Unicode property).
_WS = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BLANK_RUN = re.compile(f"[{_WS}]{{{LONG_BLANK},}}")
# A blank after a visible ASCII character starts a piece of its own, whatever follows; so does a digit after a
# letter or a letter after a digit.
_SAFE = re.compile(r"(?<=[!-~])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


@functools.lru_cache(maxsize=2)
def _ranks(rank_file: str) -> dict[bytes, int]:
    """Bytes and id of each token, read once in a process. rank_file: a path of this machine or a URI of a shared
    folder, so that no executor needs a copy of its own."""
    with open_read(rank_file) as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines())}


def encoder(rank_file: str = RANK_FILE) -> Callable[[str | None], list[int]]:
    """A function from a text to its ids. Null and empty text give an empty list."""
    import tiktoken

    enc = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=_ranks(rank_file), special_tokens={})

    def encode(text: str | None) -> list[int]:
        if not text:
            return []
        if len(text) <= CHUNK:
            if len(text) <= LONG_BLANK or not _BLANK_RUN.search(text):
                return enc.encode_ordinary(text)
        out: list[int] = []
        for piece, whole in safe_pieces(text):
            out += enc._core_bpe.encode_single_piece(piece.encode()) if whole else enc.encode_ordinary(piece)
        return out

    return encode


def safe_pieces(text: str) -> Iterator[tuple[str, bool]]:
    """The text cut only where the pattern cuts too; (part, whether it is one piece of the pattern).

    The pattern backtracks over a run of white space, which overflows on very long ones: such a run is
    handed out as the single piece it forms (without its last character if something follows).
    """
    at = 0
    for run in _BLANK_RUN.finditer(text):
        yield from _cut(text, at, run.start())
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : at], True
    yield from _cut(text, at, len(text))


def _cut(text: str, a: int, z: int) -> Iterator[tuple[str, bool]]:
    while z - a > CHUNK:
        m = _SAFE.search(text, a + CHUNK, z)
        if not m:
            break
        yield text[a : m.start()], False
        a = m.start()
    if a < z:
        yield text[a:z], False


@functools.lru_cache(maxsize=2)
def _parts(rank_file: str) -> dict[int, bytes]:
    return {i: part for part, i in _ranks(rank_file).items()}


def decode(ids: list[int], rank_file: str = RANK_FILE) -> bytes:
    """The bytes of ids; raw, for a cut between two ids may lie inside a character."""
    parts = _parts(rank_file)
    return b"".join(parts[i] for i in ids)


def decode_ids(df: DataFrame, key: str, ids: str, rank_file: str = RANK_FILE) -> DataFrame:
    """key and bytes (binary) of every row: the reverse of encode_texts. Null ids give null; an id that the
    vocabulary hasn't raises."""
    d = df.select(df[key].alias("k"), df[ids].alias("i"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [None if x is None else decode(x, rank_file) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary())], [key, "bytes"])

    return d.mapInArrow(run, f"`{key}` {d.schema['k'].dataType.simpleString()}, bytes binary")


def encode_texts(df: DataFrame, key: str, text: str, rank_file: str = RANK_FILE) -> DataFrame:
    """key and ids (array of int) of every row of df; one row for each row, repeated keys too.

    Defined cases: null and empty texts give an empty array; special tokens' strings are ordinary text; very
    long texts are encoded whole; an empty table gives no rows; other columns aren't read.
    """
    d = df.select(df[key].alias("k"), df[text].alias("t"))
    name = key

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(rank_file)
        for b in batches:
            keys, ids, size = [], [], 0
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                keys.append(k)
                ids.append(encode(t.as_py()))
                size += len(ids[-1])
                if size > 1_000_000:
                    yield _batch(name, b.schema.field(0).type, keys, ids)
                    keys, ids, size = [], [], 0
            if keys:
                yield _batch(name, b.schema.field(0).type, keys, ids)

    kind = d.schema["k"].dataType.simpleString()
    return d.mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def _batch(name: str, kind: pa.DataType, keys: list, ids: list[list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(ids, pa.list_(pa.int32()))], [name, "ids"])


def count_tokens(df: DataFrame, text: str, name: str = "n_tokens", rank_file: str = RANK_FILE) -> DataFrame:
    """df's other columns and the number of tokens of each text (0 for null and empty). A column of df that has the
    name of the result is replaced."""
    rest = [c for c in df.columns if c not in (text, name)]
    d = df.select(*rest, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(rank_file)
        for b in batches:
            n = pa.array([len(encode(t.as_py())) for t in b.column(len(rest))], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], [*rest, name])

    schema = ", ".join(f"`{c}` {d.schema[c].dataType.simpleString()}" for c in rest)
    return d.mapInArrow(run, f"{schema}{', ' if rest else ''}`{name}` bigint")
