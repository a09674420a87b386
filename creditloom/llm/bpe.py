"""Byte-pair encoding of whole texts and its inverse, for vocabulary files with word-end merges.

Text is cut at the file's special strings, normalised (NFC, white space to blanks, lower case) and split into
pre-tokens; each pre-token is merged by rank, long ones by a priority queue over a doubly linked list of symbols.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, pre_tokenizers

from creditloom.llm.common import by_batch, column, text_of

#: Characters whose normal form, lower case and class are the same in every Unicode version: two Latin blocks and
#: common punctuation.  Texts within them are split here, all others by the library's own normaliser and splitter.
LATIN = "\x00-ſ‐-‧€"
NOT_LATIN = re.compile(f"[^{LATIN}]")
LETTERS = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = "\t-\r \x85\xa0"
LATIN_PIECES = re.compile(f"[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{DIGITS}]|[^{SPACES}{LETTERS}{DIGITS}]+")
#: What the splitter above stands for; a file with another rule is refused.
SPLIT_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CACHED_WORDS = 300_000
#: Symbols up to which a pre-token is merged by scanning its ranks, which is quadratic but has no queue to keep.
SCANNED_SYMBOLS = 48


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1 stands for itself, the others follow at 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordCache(dict):
    """Encoded pre-tokens of a worker; emptied when full, so memory stays bounded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = array("i", self.encode(word)).tobytes()
        return found


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        if splitter["pattern"]["Regex"] != SPLIT_RULE or steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError(f"{path}: only word-end BPE files with the known normaliser and splitter are read")
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = specials
        self.names = {i: s for s, i in {**self.vocab, **specials}.items()}
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[left], self.vocab[right]] = (rank, self.vocab[left + right])
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")")
        self.no_merge = len(model["merges"])
        self.made = [0] * self.no_merge
        self.ranks: list[dict[int, int]] = [{} for _ in range(max(self.names) + 1)]  # by left, then right symbol
        for (left, right), (rank, new) in self.merges.items():
            self.ranks[left][right], self.made[rank] = rank, new
        letters = byte_letters()
        self.inner = [self.vocab[s] for s in letters]
        self.final = [self.vocab[s + self.suffix] for s in letters]
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.splitter = pre_tokenizers.Split(Regex(SPLIT_RULE), "removed", invert=True)
        self.words = WordCache(self.encode_word)
        self.words.update((s, np.array([i], np.int32).tobytes()) for s, i in specials.items())

    def pretokens(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if text.isascii() or not NOT_LATIN.search(text):
            return LATIN_PIECES.findall(text.lower())
        return [piece for piece, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))]

    def pieces_of(self, text: str) -> tuple[list[str], list[str]]:
        """(pre-tokens, special strings) in reading order within each list."""
        if "<|" not in text:
            return self.pretokens(text), []
        parts = self.special_split.split(text)
        return [w for part in parts[::2] for w in self.pretokens(part)], parts[1::2]

    def encode_word(self, word: str) -> list[int]:
        """Merge one pre-token: by rank, then by place."""
        if word in self.specials:
            return [self.specials[word]]
        raw = word.encode("utf-8", "surrogatepass")
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.final[raw[-1]]
        return self.merge_scanned(ids) if len(ids) <= SCANNED_SYMBOLS else self.merge_queued(ids)

    def merge_scanned(self, ids: list[int]) -> list[int]:
        """The lowest rank, the leftmost of equal ones, is looked for after every merge."""
        after, made, none = self.ranks, self.made, self.no_merge
        ranks = [after[left].get(right, none) for left, right in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) < none:
            at = ranks.index(rank)
            ids[at] = new = made[rank]
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = after[new].get(ids[at + 1], none)
            if at:
                ranks[at - 1] = after[ids[at - 1]].get(new, none)
        return ids

    def merge_queued(self, ids: list[int]) -> list[int]:
        """Pairs leave the queue by rank, then by place; entries whose pair is gone are stale."""
        last = len(ids)
        after, before = list(range(1, last + 1)), list(range(-1, last - 1))
        merges = self.merges
        queue = [(*merges[pair], at, pair) for at, pair in enumerate(zip(ids, ids[1:])) if pair in merges]
        queue = [(rank, at, new, pair) for rank, new, at, pair in queue]
        heapq.heapify(queue)
        while queue:
            _, at, new, pair = heapq.heappop(queue)
            right = after[at]
            if right >= last or ids[at] != pair[0] or ids[right] != pair[1]:
                continue
            ids[at], ids[right] = new, -1
            after[at] = beyond = after[right]
            if beyond < last:
                before[beyond] = at
                if found := merges.get((new, ids[beyond])):
                    heapq.heappush(queue, (found[0], at, found[1], (new, ids[beyond])))
            if (left := before[at]) >= 0:
                if found := merges.get((ids[left], new)):
                    heapq.heappush(queue, (found[0], left, found[1], (ids[left], new)))
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> bytes:
        """Ids of a text as packed 32-bit integers."""
        if "<|" not in text:
            return b"".join(map(self.words.__getitem__, self.pretokens(text)))
        parts = self.special_split.split(text)
        for at in range(0, len(parts), 2):
            parts[at] = self.pretokens(parts[at])
        return b"".join(
            self.words[part] if isinstance(part, str) else b"".join(map(self.words.__getitem__, part)) for part in parts
        )

    def decode(self, ids) -> str:
        """Vocabulary strings joined by a blank, as the library does for files without a decoder."""
        return " ".join(map(self.names.__getitem__, ids))


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


OUT_BYTES = 8 << 20  # of an output batch, which keeps worker memory bounded


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """One row per document: (doc_id, ids array<int>), with ``decoded`` also the text that the ids decode to.

    Null and empty texts give no ids; special strings inside texts become their ids; nothing is added or cut.
    Repeated rows are encoded each, other columns are not read, an empty table gives an empty result.
    """
    source = docs.select(column(docs, id_col).alias("doc_id"), text_of(docs, text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe, keys, packed, texts, size = load(path), [], [], [], 0

        def flush() -> pa.RecordBatch:
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))
            columns = [pa.array(keys, batch.column("doc_id").type), ids]
            if decoded:
                columns.append(pa.array(texts, pa.string()))
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

        for key, text in zip(batch.column("doc_id"), batch.column("text")):
            keys.append(key.as_py())
            packed.append(bpe.encode(text.as_py()))
            if decoded:
                texts.append(bpe.decode(np.frombuffer(packed[-1], np.int32).tolist()))
            size += len(packed[-1])
            if size >= OUT_BYTES:
                yield flush()
                keys, packed, texts, size = [], [], [], 0
        if keys:
            yield flush()

    return by_batch(source, work, f"doc_id {id_type}, ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of :func:`encode` with their ``decoded`` text."""
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        texts = [bpe.decode(item.values.to_numpy().tolist()) if len(item.values) else "" for item in batch.column("ids")]
        columns = [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    return by_batch(encoded, work, f"doc_id {id_type}, ids array<int>, decoded string")
