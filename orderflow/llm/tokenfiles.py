"""Token ids in files of directly addressable codes.

An id is cut into chunks of 8 bits, lowest first. The first chunks of all ids make level 0, the second
chunks of those that have one make level 1, and so on. Every level has a bitmap that says which of
its chunks go on, and a directory with the number of set bits before each 512-bit block. The next
chunk of the chunk at place i is at place rank(i) of the next level, so any id is read in as many steps as it
has chunks, without decoding others. Small ids, which are the frequent ones, take one byte and a bit.

A file holds whole documents in ascending order of their ids:

    magic "DAC1", then little-endian uint64: documents, tokens, levels, and the chunks of each level;
    documents: int64 ids, and the place of their first token as uint64;
    each level: the chunks (uint8), the bitmap (bits from the lowest, padded to 512 bits), the
    directory (uint64 per block).

Documents are sorted by ranges of ids (equal ids by a hash of their texts), a task encodes its range document by document and closes a
file when it holds ``file_tokens`` tokens, so memory is bounded by a file and a document. Files are written
under a temporary name and renamed; a task that runs again writes the same bytes to the same name. A
manifest lists the files; the place of a file's first token is the sum of the tokens before it.
Files are reached through Arrow's file systems, so the folder may be on any store they know.

Encoding: the tokenizer splits text into words before it merges bytes, and a space followed by a
character that is no white space always starts a word. So a text is cut there. Where the tokenizer also makes a lone
line feed, and marks after a letter, words of their own (it is asked on short texts), the text is cut around and before
those, too. Texts are cut by portions, as arrays of bytes. Each distinct piece is encoded by the tokenizer and remembered (at most
about 2 x ``_REMEMBERED`` pieces and those of a portion), and the text's ids are the pieces' ids
in order: the same ids as those of the whole text, which the tests compare. Strings of added tokens in a text
are one id each, as the library has it by default, and part the text like its ends; if an added token asks for more
(stripping, whole words, normalised text), texts are encoded whole.

Defined results: a null or empty text is only the end id; rows of equal ids stand in the order of a hash of
their texts; a null document id comes first and is given back as null; an empty table gives no files and an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import os
import re
import string
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderflow.llm.common import shared_folder

FILE_TOKENS = 4_000_000
#: Files that a task reads, about.
FILES_READ = 4
END_ID = 0
_MAGIC = b"DAC1"
_BLOCK = 512
_REMEMBERED = 500_000
#: Pieces of a text that the tokenizer is given at once.
_ASKED = 200
_PLAIN = re.compile(r" ?\S+")
#: Bytes of texts that are cut and looked up at once.
_TOGETHER = 4_000_000
#: Kinds of bytes.
_WHITE, _LETTER, _MARK, _SPACE, _FEED, _LATIN, _LATIN_END, _WIDE = (1 << i for i in range(8))
#: White space of more than a byte.
_WIDE_SPACES = [c.encode() for c in map(chr, range(0x80, 0xD800)) if c.isspace()]
_NULL_ID = -(1 << 62)
MANIFEST = "file string, first_id long, n_documents long, n_tokens long"


# --- the code ----------------------------------------------------------------


def encode_file(ids: list[int] | np.ndarray, starts: np.ndarray, tokens: np.ndarray) -> bytes:
    """The bytes of a file with these documents."""
    levels, rest = [], tokens.astype(np.uint32)
    while True:
        more = rest > 0xFF
        blocks = -(-len(rest) // _BLOCK)
        bits = np.zeros(blocks * _BLOCK, bool)
        bits[: len(rest)] = more
        counts = bits.reshape(blocks, _BLOCK).sum(axis=1)
        ranks = np.concatenate(([0], np.cumsum(counts)[:-1])) if blocks else np.zeros(0)
        levels.append((rest.astype(np.uint8), np.packbits(bits, bitorder="little"), ranks.astype("<u8")))
        if not more.any():
            break
        rest = rest[more] >> np.uint32(8)
    head = [len(ids), len(tokens), len(levels), *(len(chunks) for chunks, _, _ in levels)]
    parts = [_MAGIC, np.array(head, "<u8").tobytes(), np.array(ids, "<i8").tobytes(), starts.astype("<u8").tobytes()]
    return b"".join(parts + [a.tobytes() for level in levels for a in level])


class TokenFile:
    """Random access to the bytes of one file."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a token file")
        self.n_documents, self.n_tokens, n_levels = np.frombuffer(data, "<u8", 3, 4).tolist()
        sizes = np.frombuffer(data, "<u8", n_levels, 28).tolist()
        at = 28 + 8 * n_levels
        self.ids = np.frombuffer(data, "<i8", self.n_documents, at)
        self.starts = np.frombuffer(data, "<u8", self.n_documents, at + 8 * self.n_documents)
        at += 16 * self.n_documents
        self.levels = []
        for size in sizes:
            blocks = -(-size // _BLOCK)
            chunks = np.frombuffer(data, np.uint8, size, at)
            bits = np.frombuffer(data, np.uint8, blocks * _BLOCK // 8, at + size)
            ranks = np.frombuffer(data, "<u8", blocks, at + size + len(bits))
            self.levels.append((chunks, bits, ranks))
            at += size + len(bits) + 8 * blocks

    def token(self, place: int) -> int:
        """The token at one place, by rank steps alone."""
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[place]) << shift
            if not bits[place >> 3] >> (place & 7) & 1:
                break
            block = place // _BLOCK
            own = np.unpackbits(bits[block * _BLOCK // 8 : (place >> 3) + 1], bitorder="little")
            place = int(ranks[block]) + int(own[: place - block * _BLOCK].sum())
            shift += 8
        return value

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """The tokens of a range; only the blocks that it touches are read, at every level."""
        out = np.zeros(max(stop - start, 0), np.uint32)
        places = np.arange(len(out))
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            if not len(places):
                break
            out[places] |= chunks[start:stop].astype(np.uint32) << np.uint32(8 * level)
            block = start // _BLOCK
            own = np.unpackbits(bits[block * _BLOCK // 8 : -(-stop // 8)], bitorder="little")
            begin = start - block * _BLOCK
            more = own[begin : begin + len(places)].astype(bool)
            start = int(ranks[block]) + int(own[:begin].sum())
            places = places[more]
            stop = start + len(places)
        return out


# --- tokenizing --------------------------------------------------------------


def _kinds() -> bytes:
    kinds = bytearray(256)
    for i in range(128):
        kinds[i] = _WHITE * chr(i).isspace() | _LETTER * chr(i).isalpha()
    for c in string.punctuation:
        kinds[ord(c)] |= _MARK * (c != "'")  # which may be part of a contraction
    kinds[ord(" ")] |= _SPACE
    kinds[ord("\n")] |= _FEED
    kinds[0xC3] |= _LATIN
    for c in map(chr, range(0xC0, 0x100)):
        kinds[c.encode()[1]] |= _LATIN_END * c.isalpha()
    for c in _WIDE_SPACES:
        kinds[c[0]] |= _WIDE
    return bytes(kinds)


_KINDS = _kinds()


def pieces(data: bytes, bounds: np.ndarray, lines: bool = False) -> np.ndarray:
    """For each byte of UTF-8, whether a piece begins there; no cut falls inside a word of the tokenizer.

    ``bounds`` are the places where texts begin and end. Texts are cut before a space; with ``lines`` before and
    after line feeds, and before marks that follow a letter, too. White space next to other white space is never
    cut off from it.
    """
    kinds = np.frombuffer(data.translate(_KINDS), np.uint8)
    cut = np.zeros(len(data), np.uint8)
    if not len(data):
        return cut.view(bool)
    if (wide := np.flatnonzero(kinds & _WIDE)).size:
        kinds, there = kinds.copy(), np.frombuffer(data + b"\0\0", np.uint8)
        for space in [c for c in _WIDE_SPACES if c in data]:
            at = wide[np.logical_and.reduce([there[wide + i] == byte for i, byte in enumerate(space)])]
            for i in range(len(space)):
                kinds[at + i] = _WHITE
    cut[:-1] = (kinds[:-1] & _SPACE != 0) & (kinds[1:] & _WHITE == 0)
    # What follows the last space of a text is another text.
    bounds = np.unique(bounds)
    cut[bounds[bounds > 0] - 1] = 0
    if lines:
        lone = (kinds[1:-1] & _FEED != 0) & ((kinds[:-2] | kinds[2:]) & _WHITE == 0)
        cut[1:-1] |= lone
        cut[2:] |= lone
        letter = kinds[:-1] & _LETTER != 0
        letter[1:] |= (kinds[:-2] & _LATIN != 0) & (kinds[1:-1] & _LATIN_END != 0)
        cut[1:] |= letter & (kinds[1:] & _MARK != 0)
    cut[bounds[bounds < len(data)]] = 1
    return cut.view(bool)


class Encoder:
    """Ids of whole texts, with remembered pieces.

    Pieces are remembered with the number of the portion that held them last. Where they get too many, those
    met longest ago are forgotten.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.whole = any(a.lstrip or a.rstrip or a.single_word or a.normalized for a in added)
        names = sorted((a.content.encode() for a in added), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, names))) if names else None
        self.feed = self._feed()
        self.rows: dict[bytes, int] = {}
        self.ids = pa.array([], pa.large_binary())
        self.met = np.zeros(0, np.int64)
        self.portions = 0

    def _feed(self) -> int | None:
        """The id of a line feed, if between other characters it is a word of its own, and so are marks after a letter."""
        split = self.tokenizer.pre_tokenizer
        probes = {"a.\nb": [1, 2, 3, 4], "a\n.": [1, 2, 3], "a\n a": [1, 2, 4], "a.,$": [1, 4]}
        probes |= {f"{a}{c}b": [1, 2, 3] for a in "aé" for c in string.punctuation if c != "'"}
        if split is None or any([e for _, (_, e) in split.pre_tokenize_str(t)] != ends for t, ends in probes.items()):
            return None
        if any("\n" in a.content for a in self.tokenizer.get_added_tokens_decoder().values()):
            return None
        a, feed, both = (self.tokenizer.encode(t, add_special_tokens=False).ids for t in ("a", "\n", "a\na"))
        return feed[0] if len(feed) == 1 and both == a + feed + a else None

    def _asked(self, texts: list[str]) -> tuple[list[np.ndarray], list[int]]:
        """The ids of each text, and how many these are."""
        found = [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return found, [len(x) for x in found]

    def _learn(self, new: list[bytes]) -> np.ndarray:
        """Ask for the ids of pieces and remember them; their rows."""
        texts = [p.decode() for p in new]
        plain = [self.feed is not None and _PLAIN.fullmatch(t) is not None for t in texts]
        order = np.argsort(~np.array(plain, bool), kind="stable")
        ids, counts = [], []
        # One text is encoded faster than many: a line feed is a token that nothing else holds.
        joined = [t for t, p in zip(texts, plain, strict=True) if p]
        for begin in range(0, len(joined), _ASKED):
            part = joined[begin : begin + _ASKED]
            found = self._asked(["\n".join(part)])[0][0]
            feeds = np.flatnonzero(found == self.feed)
            if len(feeds) != len(part) - 1:
                raise ValueError("the tokenizer does not part lines")
            ids.append(np.delete(found, feeds))
            counts.append(np.diff(feeds, prepend=-1, append=len(found)) - 1)
        for begin in range(0, len(texts) - len(joined), _ASKED):
            found, many = self._asked([texts[i] for i in order[len(joined) + begin :][:_ASKED]])
            ids += found
            counts.append(many)
        rows = np.empty(len(new), np.int64)
        rows[order] = np.arange(len(self.rows), len(self.rows) + len(new))
        self.rows.update([(new[i], row) for row, i in enumerate(order.tolist(), len(self.rows))])
        self.ids = pa.concat_arrays([self.ids, _binaries(ids, np.concatenate(counts))])
        self.met = np.append(self.met, np.zeros(len(new), np.int64))
        return rows

    def _forget(self) -> None:
        kept = np.sort(np.argsort(-self.met, kind="stable")[:_REMEMBERED])
        names = list(self.rows)
        self.rows = {names[i]: row for row, i in enumerate(kept.tolist())}
        self.ids, self.met = self.ids.take(pa.array(kept)), self.met[kept]

    def _known(self, names: list[bytes]) -> pa.Array:
        """The ids of distinct pieces, as bytes."""
        self.portions += 1
        if len(self.rows) > 2 * _REMEMBERED:
            self._forget()
        rows = np.fromiter(map(self.rows.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(rows < 0)
        if len(new):
            rows[new] = self._learn([names[i] for i in new.tolist()])
        self.met[rows] = self.portions
        return self.ids.take(pa.array(rows))

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, which are strings that are not null, and where those of each text end."""
        texts = texts.cast(pa.string())
        if self.whole:
            found, counts = self._asked(texts.to_pylist())
            return np.concatenate([np.zeros(0, "<u4"), *found]), np.cumsum(counts, dtype=np.int64)
        if not pc.any(pc.greater(pc.binary_length(texts), 0)).as_py():
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        begin, at = int(at[0]), at - at[0]
        data = texts.buffers()[2].slice(begin, int(at[-1])).to_pybytes()
        marks = []
        if self.special is not None and self.special.search(data):
            ranges = zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
            marks = [m.span() for a, b in ranges for m in self.special.finditer(data, a, b)]
        cut = pieces(data, np.concatenate([at, np.array(marks, np.int32).reshape(-1)]), self.feed is not None)
        for a, b in marks:
            cut[a + 1 : b] = False
        starts = np.flatnonzero(cut).astype(np.int32)
        ends = pa.py_buffer(np.append(starts, at[-1]))
        held = pa.Array.from_buffers(pa.binary(), len(starts), [None, ends, pa.py_buffer(data)]).dictionary_encode()
        found = self._known(held.dictionary.to_pylist()).take(held.indices)
        upto = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1]
        size = int(upto[-1] - upto[0]) // 4
        tokens = np.frombuffer(found.buffers()[2], "<u4", size, int(upto[0])) if size else np.zeros(0, "<u4")
        return tokens, (upto[np.searchsorted(starts, at[1:])] - upto[0]) // 4

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian uint32."""
        tokens, ends = self.tokens(pa.array(texts, pa.string()))
        return [tokens[end - size : end].tobytes() for end, size in zip(ends, np.diff(ends, prepend=0), strict=True)]


def _binaries(ids: list[np.ndarray], counts: np.ndarray) -> pa.Array:
    """Arrays of ids, joined, as one value of bytes for each count."""
    ends = np.concatenate(([0], np.cumsum(counts, dtype=np.int64))) * 4
    data = np.concatenate(ids).astype("<u4", copy=False)
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(data)])


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Encoder(path)


# --- files -------------------------------------------------------------------


def file_system(uri: str):
    """Arrow's file system of a folder, and the path in it."""
    from pyarrow import fs

    if "://" not in uri:
        uri = re.sub(r"^(file:)?/*", "file:///", uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def _write(folder: str, name: str, data: bytes) -> None:
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    hidden = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(hidden) as out:
        out.write(data)
    system.move(hidden, f"{path}/{name}")


def _writer(folder: str, tokenizer: str, end_id: int, file_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, coder = TaskContext.get().partitionId(), encoder(tokenizer)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        made = count = 0

        def close() -> pa.RecordBatch:
            ids, sizes, tokens = (np.concatenate(parts) for parts in zip(*held, strict=True))
            name = f"part-{task:06d}-{made:06d}.dac"
            _write(folder, name, encode_file(ids, np.cumsum(sizes) - sizes, tokens))
            row = {"file": name, "first_id": int(ids[0]), "n_documents": len(ids), "n_tokens": len(tokens)}
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for part in _portions(batch):
                ids = part.column("id").to_numpy()
                tokens, ends = coder.tokens(part.column("text"))
                tokens, ends = np.insert(tokens, ends, end_id), ends + np.arange(1, len(ends) + 1)
                sizes = np.diff(ends, prepend=0)
                first = start = 0
                while first < len(ids):
                    # A file is full with the document that reaches its size.
                    last = min(int(np.searchsorted(ends, start + file_tokens - count)) + 1, len(ids))
                    stop = int(ends[last - 1])
                    held.append((ids[first:last], sizes[first:last], tokens[start:stop]))
                    count += stop - start
                    first, start = last, stop
                    if count >= file_tokens:
                        yield close()
                        held, count, made = [], 0, made + 1
        if held:
            yield close()

    return write


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in portions of about ``_TOGETHER`` bytes of text, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    group = np.cumsum(sizes, dtype=np.int64) // _TOGETHER
    places = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(places[:-1], places[1:], strict=True):
        if begin < end:
            yield batch.slice(begin, end - begin)


def write_tokens(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Write the files to ``folder`` and return the stored manifest, with each file's first place."""
    spark = documents.sparkSession
    rows = documents.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_NULL_ID)).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # Rows of one id, and equal rows, which may stand in any order, are parted by the other range keys.
    rows = rows.withColumn("hash", F.xxhash64("text"))
    ranges = (
        rows.repartitionByRange("id", "hash", F.monotonically_increasing_id())
        .sortWithinPartitions("id", "hash", "text")
        .select("id", "text")
    )
    files = ranges.mapInArrow(_writer(folder, tokenizer, end_id, file_tokens), MANIFEST)
    files.write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file; ``base`` is the number of tokens in the files before it."""
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _reader(folder: str, key: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, base in zip(batch.file, batch.base, strict=True):
                system, path = file_system(folder)
                with system.open_input_stream(f"{path}/{name}") as data:
                    held = TokenFile(data.read())
                # A file is bounded, and one range costs less than one per document.
                tokens = held.tokens(0, held.n_tokens).astype("<u4", copy=False)
                ends = np.append(held.starts[1:], held.n_tokens).astype(np.int64)
                rows = []
                for doc, start, end in zip(held.ids.tolist(), held.starts.tolist(), ends.tolist(), strict=True):
                    rows.append((doc, base + start, end - start, zlib.crc32(tokens[start:end])))
                out = pd.DataFrame(rows, columns=[key, "start", "n_tokens", "ids_crc32"])
                out[key] = out[key].astype("Int64").mask(out[key] == _NULL_ID)
                yield out

    return read


def read_documents(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """One row per document, from the files: the key, ``start``, ``n_tokens``, ``ids_crc32``."""
    files = read_manifest(spark, folder).select("file", "base")
    # A count of its own: the manifest is so small that one task would get it all.
    files = files.repartition(-(-files.count() // FILES_READ) or 1, "file")
    return files.mapInPandas(_reader(folder, key), f"{key} long, start long, n_tokens long, ids_crc32 long")


def round_trip(documents: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents to a new shared folder and read the files back."""
    spark = documents.sparkSession
    folder = shared_folder(spark, "tokens")
    write_tokens(documents, folder, tokenizer)
    return read_documents(spark, folder)
