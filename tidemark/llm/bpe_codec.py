"""BPE encoding and decoding by speculation: a greedy proposal that is verified, and exact merging where it fails.

A text is brought to its words as the tokenizer file says (special tokens cut out, NFC, white space, lower case, the
split pattern). Distinct words are encoded together:

1. Speculate: at every place of every word, the longest token that starts there; substring fingerprints probe the sorted
   token keys, length by length. Following these from a word's start proposes its tokens.
2. Verify: tokens t1 t2 ... are a word's encoding exactly if each encodes to itself and every neighbouring pair does not
   merge across its border. A pair is checked by undoing the merges of its two sides from the latest on, while they touch:
   the touching parts must have no merge earlier than the undone one. All pairs of all words are checked at once, by
   distinct pair. Proposed tokens are also compared with the word, sign by sign, so fingerprints can't mislead.
3. Words that fail are merged exactly, the least rank first, the leftmost of equals: short ones all together, each round
   merging every word's pair of least rank; long ones from a heap, which takes no time by the square of their length.

A task remembers a bounded number of short words and their tokens, which only saves time. The tables (bounded by the tokenizer file)
are read on the driver and broadcast; each document is encoded by itself, so nothing is shuffled.

Defined results: null and empty texts, and those of white space only, have no ids; null ids decode to null, no ids to the
empty text; special tokens written in a text are their ids, as the tokenizers library has it; very long texts are
encoded whole, in stretches that end at white space, very long words by the same steps; ties between merges of one rank
go to the leftmost; repeated rows are encoded alike; ids outside the vocabulary decode to nothing; empty tables give
empty results; extra columns pass through `encode` and `decode` untouched, whatever they are called.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import from_row, in_row, shape, slices
from .hashing import blocks, mix, ranges, running

MODEL = "word_bpe_49k.json"
_U = np.uint64
#: A stretch of text, and a block of words, have about so many characters.
STRETCH = 1 << 18
#: Bytes of a word that is merged together with others.
LONG = 64
NEVER = np.iinfo(np.int64).max
#: White space of the tokenizer's \\s. Python's str.split also splits at the controls \\x1c-\\x1f, which are no white space there.
_SPACE = regex.compile(r"\p{White_Space}+")
_CONTROLS = re.compile("[\x1c-\x1f]")


def model_path(name: str) -> str:
    """Where a public tokenizer's file is; a path stays as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_signs() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary: itself where it is printable, else the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, more = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else more))
        more += b not in plain
    return out


class Vocabulary:
    """A tokenizer file's tables. A sign is a byte, plus 256 where it ends its word."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text("utf-8"))
        model, suffix = spec["model"], spec["model"].get("end_of_word_suffix") or ""
        names = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        if model.get("type", "BPE") != "BPE" or not suffix or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges") or spec.get("decoder"):
            raise ValueError(f"{path} is no BPE model with word ends and no decoder")
        if names != ["NFC", "Replace", "Lowercase"] or [s.get("type") for s in split] != ["Split", "ByteLevel"] or not split[0].get("invert"):
            raise ValueError(f"{path} brings texts to words in a way that is not supported")
        self.pattern = split[0]["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        ids: dict[str, int] = model["vocab"]
        size = 1 + max([*ids.values(), *self.special.values()])
        self.tokens = [""] * size
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        signs: list[tuple[int, ...] | None] = [None] * size
        for b, c in enumerate(byte_signs()):
            signs[ids[c]], signs[ids[c + suffix]] = (b,), (b + 256,)
        self.base = np.array([ids[c + end] for end in ("", suffix) for c in byte_signs()])
        for n, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            made = ids[a + b]
            if signs[made] is not None:
                raise ValueError(f"{path} has two merges for one token")
            if signs[ids[a]] is None or signs[ids[b]] is None:
                raise ValueError(f"{path} merges tokens before they are made")
            self.rank[made], self.left[made], self.right[made] = n, ids[a], ids[b]
            signs[made] = (*signs[ids[a]], *signs[ids[b]])
        merged = np.flatnonzero(self.rank >= 0)
        self.pairs = (self.left[merged].astype(_U) << _U(32)) | self.right[merged].astype(_U)
        order = np.argsort(self.pairs)
        self.pairs, self.made = self.pairs[order], merged[order]
        # tokens that encode to themselves, the later ones made of earlier ones
        stable = self.rank < 0
        alone = self.compatible(self.left[merged], self.right[merged], self.rank[merged])
        for i, fits in sorted(zip(merged.tolist(), alone.tolist(), strict=True), key=lambda x: self.rank[x[0]]):
            stable[i] = fits and stable[self.left[i]] and stable[self.right[i]]
        own = [i for i in range(size) if signs[i] is not None and stable[i]]
        flat = np.concatenate([np.array(signs[i], np.int64) for i in own])
        self.most = max(len(signs[i]) for i in own)
        ends = np.cumsum([len(signs[i]) for i in own])
        keys = ranges(running(mix(flat)), ends - [len(signs[i]) for i in own], ends)
        order = np.argsort(keys)
        self.keys, self.of_key = keys[order], np.array(own)[order]
        self.taken = np.zeros(1 << 20, bool)  # by the leading bits of keys: most fingerprints that are no token's stop here
        self.taken[self.keys >> _U(44)] = True
        self.lengths = np.array([len(s or ()) for s in signs])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.signs = np.concatenate([np.array(s or (), np.int64) for s in signs])

    def compatible(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether each pair of tokens stands side by side without a merge over its border (of merges before `limit`)."""
        left, right = left.copy(), right.copy()
        limit = np.full(len(left), NEVER) if limit is None else limit.copy()
        fits = np.ones(len(left), bool)
        open_ = np.arange(len(left))
        while len(open_):
            a, b = left[open_], right[open_]
            pair = (a.astype(_U) << _U(32)) | b.astype(_U)
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            merges = (self.pairs[at] == pair) & (self.rank[self.made[at]] < limit[open_])
            fits[open_[merges]] = False
            # undo the side that was made last; of one merge on both sides the left one was made first
            over = self.rank[a] > self.rank[b]
            limit[open_] = np.where(over, self.rank[a], self.rank[b] + 1)
            left[open_], right[open_] = np.where(over, self.right[a], a), np.where(over, b, self.left[b])
            open_ = open_[~merges & ((self.rank[a] >= 0) | (self.rank[b] >= 0))]
        return fits


class Encoder:
    """Encodes words, and what texts hold of them, by a vocabulary."""

    def __init__(self, vocabulary: Vocabulary, remember: int = 500_000):
        self.v = vocabulary
        self.find = regex.compile(vocabulary.pattern).findall
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")").split if names else lambda text: [text]
        self.remember = remember
        self._forget()
        self.letters = r"[\p{L}]+" in vocabulary.pattern.split("|")  # a chunk of letters alone is one word
        self.merges = dict(zip(vocabulary.pairs.tolist(), vocabulary.made.tolist(), strict=True))
        self.failed = self.proposed = 0

    def merged(self, word: bytes) -> list[int]:
        """Exact merging of one word: the least rank first, the leftmost of equals, from a heap."""
        base, rank = self.v.base, self.v.rank
        ids = base[list(word)].tolist()
        ids[-1] = int(base[256 + word[-1]])
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) < len(ids) and (made := self.merges.get(ids[i] << 32 | ids[j])) is not None:
                heapq.heappush(heap, (int(rank[made]), i, ids[i], ids[j]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            if ids[i] != a or (j := after[i]) >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = self.merges[a << 32 | b], -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def merged_together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many short words, their ids and the word of each: each round merges every word's pair of least rank, wherever it stands.

        What a merge makes only takes part in later merges, so a word's equal pairs can go in one round.
        """
        v = self.v
        ends = np.cumsum([len(w) for w in words])
        signs = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        signs[ends - 1] += 256
        ids, word = v.base[signs], np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
        done_ids, done_words = [], []
        while len(ids):
            pair = np.append((ids[:-1].astype(_U) << _U(32)) | ids[1:].astype(_U), _U(0))
            inside = np.append(word[1:] == word[:-1], False)
            at = np.minimum(np.searchsorted(v.pairs, pair), len(v.pairs) - 1)
            made = v.made[at]
            rank = np.where(inside & (v.pairs[at] == pair), v.rank[made], NEVER)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, first)
            own = np.cumsum(np.append(False, word[1:] != word[:-1]))
            ready = (least == NEVER)[own]
            if ready.any():
                done_ids.append(ids[ready])
                done_words.append(word[ready])
            chosen = np.flatnonzero((rank == least[own]) & ~ready)
            if not len(chosen):
                break
            # of overlapping pairs (one token again and again) every second one, from the left
            fresh = np.append(True, np.diff(chosen) > 1)
            begin = np.flatnonzero(fresh)
            turn = np.arange(len(chosen)) - begin[np.cumsum(fresh) - 1]
            chosen = chosen[turn % 2 == 0]
            ids = ids.copy()
            ids[chosen] = made[chosen]
            keep = ~ready
            keep[chosen + 1] = False
            ids, word = ids[keep], word[keep]
        return np.concatenate(done_ids), np.concatenate(done_words)

    def proposals(self, signs: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of words (their signs, one word after the other): tokens, and the word of each."""
        v, n = self.v, len(signs)
        sums = running(mix(signs))
        left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)  # signs up to the word's end
        step, token = np.zeros(n, np.int64), np.zeros(n, np.int64)
        open_ = np.argsort(-left, kind="stable")  # places by what is left, so that each length takes a leading part
        reach = np.searchsorted(-left[open_], -np.arange(v.most + 1), side="right")
        found = np.zeros(n, bool)
        for size in range(v.most, 0, -1):
            at = open_[: reach[size]]
            at = at[~found[at]]
            if len(at):
                key = ranges(sums, at, at + size)
                maybe = self.v.taken[key >> _U(44)]
                at, key = at[maybe], key[maybe]
                k = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
                hit = v.keys[k] == key
                at, k = at[hit], k[hit]
                found[at], step[at], token[at] = True, size, v.of_key[k]
        step[~found] = 1
        words, at = np.arange(len(ends)), np.concatenate(([0], ends[:-1]))
        tokens, owners = [], []
        while len(words):
            tokens.append(token[at])
            owners.append(words)
            at = at + step[at]
            more = at < ends[words]
            words, at = words[more], at[more]
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(tokens)[order], owner[order]

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one word after the other, and each one's number of ids. No word is empty."""
        out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        first = size = 0
        for i, w in enumerate(words):
            if i > first and size + len(w) > STRETCH:
                out.append(self._block(words[first:i]))
                first, size = i, 0
            size += len(w)
        if first < len(words):
            out.append(self._block(words[first:]))
        return np.concatenate([x for x, _ in out]), np.concatenate([n for _, n in out])

    def _block(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        v = self.v
        ends = np.cumsum([len(w) for w in words])
        signs = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        signs[ends - 1] += 256
        token, owner = self.proposals(signs, ends)
        good = np.ones(len(words), bool)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, place = np.unique((token[inside].astype(_U) << _U(32)) | token[inside + 1].astype(_U), return_inverse=True)
        fits = v.compatible((pairs >> _U(32)).astype(np.int64), (pairs & _U(0xFFFFFFFF)).astype(np.int64))
        good[owner[inside[~fits[place]]]] = False
        size = v.lengths[token]
        spelt = v.signs[np.repeat(v.starts[token] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        if len(spelt) == len(signs):
            own = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
            good[own[spelt != signs]] = False
        else:
            good[:] = False
        self.proposed += len(words)
        self.failed += int((~good).sum())
        kept = good[owner]
        ids, owners = [token[kept]], [owner[kept]]
        failed = np.flatnonzero(~good)
        long = np.array([len(words[i]) > LONG for i in failed], bool)
        if len(short := failed[~long]):
            more, own = self.merged_together([words[i] for i in short])
            ids.append(more)
            owners.append(short[own])
        for i in failed[long].tolist():
            ids.append(np.array(self.merged(words[i]), np.int64))
            owners.append(np.full(len(ids[-1]), i))
        owner = np.concatenate(owners)
        return np.concatenate(ids)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def _parts(self, text: str) -> Iterator[list[str]]:
        """The text's chunks between white space, stretch by stretch; a special token stands as one that starts with a blank."""
        for segment in self.cut(text):
            if segment in self.v.special:
                yield [" " + segment]
                continue
            if not segment.isascii():
                segment = unicodedata.normalize("NFC", segment).replace("Σ", "σ")  # a final sigma is no other letter here
            low, a = segment.lower(), 0
            whole = not _CONTROLS.search(low)
            while a < len(low):
                b = len(low)
                if b - a > 2 * STRETCH:
                    cut = _SPACE.search(low, a + STRETCH)
                    b = cut.start() if cut else b
                part = low[a:b]
                yield part.split() if whole else [x for x in _SPACE.split(part) if x]
                a = b

    def _chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks, one after the other, and each one's number of ids."""
        number: dict[str, int] = {}
        found, sizes, special = [], [], {}
        for c in chunks:
            if self.letters and c.isalpha():
                found.append(number.setdefault(c, len(number)))
                sizes.append(1)
            elif c[0] == " ":
                special[len(found)] = self.v.special[c[1:]]
                found.append(0)
                sizes.append(1)
            else:
                words = self.find(c)
                found += [number.setdefault(w, len(number)) for w in words]
                sizes.append(len(words))
        ids, counts = self.words([w.encode() for w in number])
        begin, at = np.cumsum(counts) - counts, np.array(found, np.int64)
        if special:  # a word of one id each, at the end
            at[list(special)] = len(counts) + np.arange(len(special))
            begin = np.append(begin, len(ids) + np.arange(len(special)))
            counts, ids = np.append(counts, np.ones(len(special), np.int64)), np.append(ids, list(special.values()))
        n = counts[at]
        bounds = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(np.array(sizes, np.int64)))]
        return _gathered(ids, begin[at], n), np.diff(bounds)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, one text after the other, and each one's number of ids."""
        ids, sizes = [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
        for a, b in blocks([t or "" for t in texts], STRETCH):
            if b - a == 1 and len(texts[a] or "") > STRETCH:
                parts = [self._chunks_of(part) for part in self._parts(texts[a])]
                ids += parts
                sizes[a] = sum(map(len, parts))
            else:
                made, sizes[a:b] = self._short(texts[a:b])
                ids.append(made)
        return np.concatenate(ids), sizes

    def _chunks_of(self, part: list[str]) -> np.ndarray:
        """The ids of a stretch of a long text, of which nothing is remembered."""
        number = {c: i for i, c in enumerate(dict.fromkeys(part))}
        ids, counts = self._chunks(list(number))
        at = np.array([number[c] for c in part], np.int64)
        return _gathered(ids, (np.cumsum(counts) - counts)[at], counts[at])

    def _short(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.memory) > self.remember or len(self.ids) > 16 * self.remember:
            self._forget()
        parts = [[c for part in self._parts(t) for c in part] if t else [] for t in texts]
        new = [c for c in set().union(*parts) if c not in self.memory]
        if new:
            ids, counts = self._chunks(new)
            self.memory.update(zip(new, range(len(self.count), len(self.count) + len(new)), strict=True))
            self.begin = np.append(self.begin, len(self.ids) + np.cumsum(counts) - counts)
            self.count, self.ids = np.append(self.count, counts), np.append(self.ids, ids)
        at = np.array([self.memory[c] for own in parts for c in own], np.int64)
        n = self.count[at]
        ends = np.append(0, np.cumsum(n))[np.cumsum([len(own) for own in parts])]
        return _gathered(self.ids, self.begin[at], n), np.diff(ends, prepend=0)

    def _forget(self) -> None:
        self.memory: dict[str, int] = {}
        self.begin = self.count = self.ids = np.zeros(0, np.int64)


def _gathered(values: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Stretches of n values each, one after the other."""
    return values[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _lists(ids: np.ndarray, sizes: np.ndarray, names: pa.Array | None = None) -> pa.ListArray:
    offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)) if names is None else names.take(pa.array(ids)))


def _rows(frame: DataFrame, value: str, name: str) -> DataFrame:
    return frame.select(in_row(frame), F.col(f"`{value}`").alias(name))


def _back(frame: DataFrame, value: str, name: str) -> DataFrame:
    return frame.select(*from_row(frame.schema["row"].dataType.names), F.col(value).alias(name))


def encode(docs: DataFrame, text: str = "text", ids: str = "input_ids", model: str = MODEL) -> DataFrame:
    """The documents with one more column, the array of ids."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_path(model)))
    frame = _rows(docs, text, "t").withColumn("t", F.col("t").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(*encoder.encode(part.column(1).to_pylist()))], names=["row", "ids"])

    return _back(frame.mapInArrow(run, shape(("row", frame.schema["row"].dataType), ("ids", "array<int>"))), "ids", ids)


def decode(encoded: DataFrame, ids: str = "input_ids", text: str = "decoded", model: str = MODEL) -> DataFrame:
    """The rows with one more column, the text that the ids spell: tokens, joined by blanks, as the file names no decoder."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(model_path(model)).tokens)
    frame = _rows(encoded, ids, "i")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(shared.value, pa.string())
        for part in slices(batches):
            known = [None if x is None else [i for i in x if i is not None and 0 <= i < len(tokens)] for x in part.column(1).to_pylist()]
            lists = pa.array(known, pa.list_(pa.int32()))
            spelt = pa.ListArray.from_arrays(lists.offsets, tokens.take(lists.flatten()), mask=lists.is_null())
            yield pa.RecordBatch.from_arrays([part.column(0), pc.binary_join(spelt, " ")], names=["row", "t"])

    return _back(frame.mapInArrow(run, shape(("row", frame.schema["row"].dataType), ("t", "string"))), "t", text)


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """Per document: n_tokens, ids_sha256 (of the ids in decimal, joined by one blank), decoded_sha256 (of the text that they decode to)."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_path(model)))
    frame = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("t"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        names, numbers = pa.array(shared.value.tokens, pa.string()), pa.array(map(str, range(len(shared.value.tokens))), pa.string())
        for part in slices(batches, 64):
            ids, sizes = encoder.encode(part.column(1).to_pylist())
            hashes = []
            for spelt in (numbers, names):
                joined = pc.binary_join(_lists(ids, sizes, spelt), " ")
                at, data = np.frombuffer(joined.buffers()[1], np.int32)[: len(joined) + 1].tolist(), memoryview(joined.buffers()[2] or b"")
                hashes.append(pa.array([hashlib.sha256(data[x:y]).hexdigest() for x, y in zip(at, at[1:], strict=False)], pa.string()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), *hashes], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = frame.mapInArrow(sums, shape(("id", docs.schema[doc_id].dataType), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")))
    return out.withColumnRenamed("id", doc_id)
