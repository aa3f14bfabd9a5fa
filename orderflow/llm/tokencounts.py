"""Token counts of whole texts, without making token ids of them.

A tokenizer cuts a text into pre-tokens and each of these, by itself, into pieces. So the pieces of a
pre-token are counted once per distinct pre-token of the whole table, and the tokens of a document are
the sum over its distinct pre-tokens of frequency times pieces.

The table of piece counts has two parts. Entries of the tokenizer's own vocabulary are counted when a worker
starts: their number is the tokenizer's, whatever the data, and most occurrences are of these. All other pre-tokens
are counted once, in the task that all their occurrences are dealt to.

Documents are read in blocks with a dictionary of their own (``blocks``): a block holds, per document,
numbers of pre-tokens and their frequencies. The dictionaries of all blocks are sorted by pre-token, each
is counted when it is met first, the answer goes back to the blocks that hold it, and the products are added up. A
pre-token that stands in every document is one row per block there. A block ends at ``WORDS`` distinct pre-tokens
or ``ENTRIES`` frequencies; a document that passes this goes on in the next block, and its parts are added up.

Tokenizers: ``.json`` files of the ``tokenizers`` library with any normalizer and pre-tokenizer, ``.model`` files of
``sentencepiece``. Strings of added tokens inside a text are one token each, as that library has it by
default; if an added token asks for more (stripping, whole words, normalised text), texts that may hold
one are counted whole by the library. Of a sentencepiece model whose pieces hold no space but at their
front, pre-tokens are words with the spaces before them; texts of other models are counted whole. No begin,
end or padding is added and nothing is truncated, whatever the file says.

The pre-tokens of byte-level files are found by the same pattern with the ``regex`` module in
texts of characters on which both agree (tried out on each when a worker starts), by the tokenizer itself in others.

Defined results: null and empty texts have no bytes and no tokens; repeated rows and null keys are
documents of their own; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.blocks import Numbers, pack, returned, told, unpack
from orderflow.llm.common import stored, text_of

#: Distinct pre-tokens and frequencies of a block, about.
WORDS, ENTRIES = 500_000, 4_000_000
#: Characters that are cut at a time.
SLICE = 1 << 20
#: Characters that are tried out when a worker starts: Latin, spaces and general punctuation.
_TRIED = [*range(0x250), *range(0x2000, 0x2070), 0x20AC]
#: The pattern of byte-level tokenizers, a fixed value.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = re.compile(r"(?<=\S) (?=\S)")


class JsonPieces:
    """Pre-tokens, and the pieces of each, of a file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        added = t.get_added_tokens_decoder().values()
        self.plain = not any(a.lstrip or a.rstrip or a.single_word or a.normalized for a in added)
        names = sorted((a.content for a in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        before = t.pre_tokenizer.__getstate__() if t.pre_tokenizer is not None else b""
        kind = before.decode() if isinstance(before, bytes) else str(before)
        self.byte_level = (
            t.normalizer is None
            and '"type":"ByteLevel"' in kind
            and '"add_prefix_space":false' in kind
            and '"use_regex":true' in kind
        )
        names = list(t.get_vocab())
        if self.byte_level:
            self._try_out()
            texts = (t.decode([i], skip_special_tokens=False) for i in t.get_vocab().values())
            names = [x for x in texts if x and not (self.special and self.special.search(x))]
        self.known = dict(zip(names, self.count(names), strict=True))

    def _try_out(self) -> None:
        import regex

        self.pattern = regex.compile(_PATTERN)
        agreed = [c for c in map(chr, _TRIED) if self._by_library(s := f"a{c}{c} b{c} 1 {c}") == self.pattern.findall(s)]
        self.unsure = re.compile("[^" + "".join(map(re.escape, agreed)) + "]")

    def _by_library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def cut(self, text: str) -> Iterator[tuple[list[str], int]]:
        """Portions of a text: pre-tokens, and the number of tokens that are none of theirs."""
        if self.special is None:
            yield from self._portions(text)
        elif not self.plain:
            yield [], self._whole(text)
        else:
            parts = self.special.split(text)
            for part in parts:
                yield from self._portions(part)
            yield [], len(parts) - 1

    def _portions(self, text: str) -> Iterator[tuple[list[str], int]]:
        if self.byte_level:
            for part in slices(text):
                yield self.pattern.findall(part) if not self.unsure.search(part) else self._by_library(part), 0
        else:
            t = self.tokenizer
            plain = t.normalizer.normalize_str(text) if t.normalizer is not None else text
            yield [w for w, _ in t.pre_tokenizer.pre_tokenize_str(plain)] if t.pre_tokenizer is not None else [plain], 0

    def count(self, words: list[str]) -> list[int]:
        if self.byte_level:
            return [len(x.ids) for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return [len(self.tokenizer.model.tokenize(w)) for w in words]


class ModelPieces:
    """The same of a ``sentencepiece`` model."""

    _WORD = re.compile("▁+[^▁]*|[^▁]+")

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        named = (self.model.id_to_piece(i) for i in range(self.model.vocab_size()))
        self.words = not any("▁" in p.lstrip("▁") for p in named) and self.model.normalize("a") == "▁a"
        self.words = self.words and len(self.model.encode("a")) == 1
        # A run of spaces is a piece of its own only if the model doesn't fold it.
        self.words = self.words and self.model.normalize("  a") == "▁▁▁a"
        names = [p for p in map(self.model.id_to_piece, range(self.model.vocab_size())) if p.startswith("▁")]
        self.known = dict(zip(names, self.count(names), strict=True)) if self.words else {}

    def cut(self, text: str) -> Iterator[tuple[list[str], int]]:
        if not self.words:
            yield [], len(self.model.encode(text))
            return
        portion = []
        for word in self._WORD.finditer(self.model.normalize(text)):
            portion.append(word[0])
            if len(portion) >= SLICE // 8:
                yield portion, 0
                portion = []
        yield portion, 0

    def count(self, words: list[str]) -> list[int]:
        if not words:
            return []
        # The model puts a space before every text, so the first one of a word is left to it; spaces
        # alone, which end a text, are counted behind a letter, which is one piece.
        plain = [w.replace("▁", " ") for w in words]
        found = self.model.encode([p[1:] if p.strip(" ") else "a" + p for p in plain])
        return [len(x) - (not p.strip(" ")) for x, p in zip(found, plain, strict=True)]


def slices(text: str) -> Iterator[str]:
    """A long text in parts that end before a space between two words, where a pre-token begins."""
    begin = 0
    while len(text) - begin > SLICE:
        gap = _CUT.search(text, begin + SLICE)
        if gap is None:
            break
        yield text[begin : gap.start()]
        begin = gap.start()
    yield text[begin:] if begin else text


@lru_cache(maxsize=2)
def pieces_of(path: str) -> JsonPieces | ModelPieces:
    return ModelPieces(path) if path.endswith(".model") else JsonPieces(path)


def _survey(tokenizer: str) -> Callable:
    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cutter = pieces_of(tokenizer)
        known = cutter.known
        base = TaskContext.get().partitionId() << 33
        row = made = 0
        words, parts, entries, kind = Numbers(), [], 0, None

        def close() -> pa.RecordBatch:
            at, freq = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, "<u4") for i in (4, 5))
            columns = {
                "block": pa.array([base + made], pa.int64()),
                "keys": pa.array([[p[0] for p in parts]], pa.list_(kind)),
                "rows": pa.array([[p[1] for p in parts]], pa.list_(pa.int64())),
                "n_bytes": pa.array([[p[2] for p in parts]], pa.list_(pa.int64())),
                "extra": pa.array([[p[3] for p in parts]], pa.list_(pa.int64())),
                "sizes": pa.array([[len(p[4]) for p in parts]], pa.list_(pa.int32())),
                # New words have the next numbers, so steps from one number to the next are mostly 1.
                "at": pa.array([pack(np.diff(at, prepend=np.uint32(0)))], pa.binary()),
                "freq": pa.array([pack(freq)], pa.binary()),
                "words": pa.array([list(words)], pa.list_(pa.string())),
            }
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            kind = batch.schema.field("key").type
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                number, n_bytes = base + row, len(text.encode("utf-8", "surrogatepass"))
                for portion, extra in cutter.cut(text) if text else [([], 0)]:
                    counts = Counter(portion)
                    for word in [w for w in counts if w in known]:
                        extra += known[word] * counts.pop(word)
                    at = np.fromiter(map(words.__getitem__, counts), "<u4", len(counts))
                    freq = np.fromiter(counts.values(), "<u4", len(counts))
                    order = np.argsort(at)
                    parts.append((key, number, n_bytes, extra, at[order], freq[order]))
                    n_bytes = 0
                    entries += len(counts) + 1
                    if len(words) >= WORDS or entries >= ENTRIES:
                        yield close()
                        made += 1
                        words, parts, entries = Numbers(), [], 0
                row += 1
        if parts:
            yield close()

    return survey


def _pieces(tokenizer: str) -> Callable:
    """Rows sorted by word: the pieces of each distinct word, given to every block that holds it."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, int] = {}
        for batch in batches:
            words = batch.column("word").dictionary_encode()
            distinct = words.dictionary.to_pylist()
            new = [w for w in distinct if w not in last]
            counts = last | dict(zip(new, pieces_of(tokenizer).count(new), strict=True))
            found = np.array([counts[w] for w in distinct], np.int32)[words.indices.to_numpy()]
            last = {w: counts[w] for w in batch.column("word")[-1:].to_pylist()}
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("at"), pa.array(found)], ["block", "at", "pieces"]
            )

    return pieces


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            block = {name: batch.column(name)[i].values for name in ("keys", "rows", "n_bytes", "extra", "sizes")}
            sizes = block["sizes"].to_numpy(zero_copy_only=False).astype(np.int64)
            n = int(sizes.sum())
            tokens = np.zeros(len(sizes), np.int64)
            if n:
                places, values = told(batch, i)
                known = np.zeros(len(places), np.int64)
                known[places] = values
                steps, freq = (unpack(batch.column(c)[i].as_py(), n) for c in ("at", "freq"))
                at = np.cumsum(steps, dtype=np.uint32)
                upto = np.concatenate(([0], np.cumsum(known[at] * freq.astype(np.int64))))
                ends = np.cumsum(sizes)
                tokens = upto[ends] - upto[ends - sizes]
            tokens = tokens + block["extra"].to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [block["rows"], block["keys"], block["n_bytes"], pa.array(tokens, pa.int64())],
                ["row", "key", "n_bytes", "n_tokens"],
            )


def count_tokens(documents: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: the key, ``n_bytes`` of the text in UTF-8 and its ``n_tokens``."""
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("key"), text_of(text).alias("text"))
    blocks = stored(
        rows.mapInArrow(
            _survey(tokenizer),
            f"block long, keys array<{kind}>, rows array<long>, n_bytes array<long>, extra array<long>, "
            "sizes array<int>, at binary, freq binary, words array<string>",
        ),
        "token-blocks",
    )
    words = blocks.select("block", F.posexplode("words").alias("at", "word"))
    pieces = words.repartition("word").sortWithinPartitions("word").mapInArrow(
        _pieces(tokenizer), "block long, at int, pieces int"
    )
    parts = returned(blocks.drop("words"), pieces, "pieces").mapInArrow(
        _summed, f"row long, key {kind}, n_bytes long, n_tokens long"
    )
    whole = parts.groupBy("row").agg(
        F.first("key").alias(key), F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens")
    )
    return whole.select(key, "n_bytes", "n_tokens")
