"""Pieces of a tokenizer model, segmented by best unigram score; shared by the encoder and the token counter.

A piece's score is the logarithm of its share under Zipf's law by its place in the model's list (the models at
hand hold merge ranks, not probabilities). Scores are integers: 1024 * round(2^20 * log share) - 1, so sums are exact,
equal sums have equally many tokens, and that number is the sum's negative modulo 1024. A character that no piece
covers costs as much as 20 units of log share and becomes its UTF-8 bytes, a token each.

Pre-tokens: a run of spaces with the non-blank characters that follow it, or one other blank character; a text starts with
an implied space. The model's sign for a space is U+2581; a U+2581 of the text itself is spelt in bytes, so decoding is exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np

from .hashing import _to, mix

_U = np.uint64
SPACE = "▁"
PRE_TOKEN = re.compile(r" *[^ \n\t\r\v\f]+| +|[\n\t\r\v\f]")
#: No character has this number; it stands for a U+2581 of the text.
_LITERAL = 0x110000
#: Stands for no character at all, beyond a word's ends.
_PAD = 0x110001
#: Characters that words are read in at a time; longer ones go on from stretch to stretch.
STRETCH = 64
_NONE = np.iinfo(np.int64).min // 4
_BITS = 20


class Pieces:
    """The vocabulary: sorted substring hashes with ids and scores, byte tokens, and every id's bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.bytes = [b""] * n
        self.byte_id = [0] * 256
        for i in range(n):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[1:-1], 16)
                self.byte_id[value], self.bytes[i] = i, bytes([value])
        texts = [model.id_to_piece(i) for i in normal]
        for i, t in zip(normal, texts, strict=True):
            self.bytes[i] = t.replace(SPACE, " ").encode()
        self.longest = max(map(len, texts))
        rank = np.arange(len(normal))
        score = np.round(-np.log(rank + 2.0) * (1 << 20)).astype(np.int64) * 1024 - 1
        keys = np.array([self._hash(t.replace(SPACE, " ")) for t in texts], _U)
        order = np.argsort(keys)
        self.keys, self.ids, self.scores = keys[order], np.array(normal, np.int32)[order], score[order]
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[(self.keys >> _U(64 - _BITS)).astype(np.int64)] = True
        self.fallback = -20 * (1 << 20) * 1024

    @staticmethod
    def _hash(text: str) -> int:
        codes = codes_of([text])
        return int(substrings(running(codes), np.array([0]), len(codes))[0])

    def probe(self, sums: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Which substrings (numbers into `start`) are pieces, and the places of those in the sorted list."""
        keys = substrings(sums, start, length)
        likely = np.flatnonzero(self.filter[(keys >> _U(64 - _BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, keys[likely]), len(self.keys) - 1)
        real = self.keys[at] == keys[likely]
        return likely[real], at[real]

    def fallback_scores(self, codes: np.ndarray) -> np.ndarray:
        """Scores of single characters spelt in bytes."""
        size = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + ((codes >= 0x10000) & (codes != _LITERAL))
        return self.fallback - size

    def spelt(self, code: int) -> list[int]:
        return [self.byte_id[b] for b in (SPACE if code == _LITERAL else chr(code)).encode("utf-8", "replace")]


def codes_of(words: list[str]) -> np.ndarray:
    """Code points of the words, one after the other; spaces as the model's sign, that sign as `_LITERAL`."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    blank, sign = codes == 32, codes == 0x2581
    codes[blank] = 0x2581
    codes[sign] = _LITERAL
    return codes


def running(codes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes) + 1, _U)
    np.cumsum(mix(codes, 31) * _to(len(codes) + 1)[0][: len(codes)], out=out[1:])
    return out


def substrings(sums: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    return mix((sums[start + length] - sums[start]) * _to(len(sums))[1][start], length)


def pre_tokens(text: str | None) -> list[str]:
    return PRE_TOKEN.findall(" " + text) if text else []


def _long_words(pieces: Pieces, words: list[str], spell: bool) -> list[np.ndarray]:
    """Best segmentations of words of more than STRETCH characters: their ids, or else only (the number of ids,).

    Words are read in stretches of STRETCH characters, and equal-length stretches of all words advance together. A stretch
    maps the best scores at the last places before it to those at its end, whatever comes before, so these maps need no
    order; applied in turn, they give each stretch the scores that it starts from. For counts, words meet in a trie of
    stretches, and a shared prefix is scored once. For ids, a second pass from known scores stores backpointers.
    """
    deep, step = pieces.longest, STRETCH
    codes = [codes_of([w]) for w in words]
    origin = np.full(deep, _NONE)
    origin[0] = 0
    front = [(origin, np.zeros(deep, np.int64)) for _ in words]  # of each word: score and number of ids at its last `deep` places
    node, nodes = [0] * len(words), {}
    came = [np.zeros(len(c) + 1 if spell else 0, np.int8) for c in codes]
    via = [np.zeros(len(c) + 1 if spell else 0, np.int32) for c in codes]
    places = sorted((i, w) for w, c in enumerate(codes) for i in range(-(-len(c) // step)))
    for a in range(0, len(places), 512):
        part = places[a : a + 512]
        rows = np.full((len(part), deep - 1 + step), _PAD)
        for r, (i, w) in enumerate(part):
            left = i * step - (deep - 1)
            own = codes[w][max(0, left) : (i + 1) * step]
            rows[r, max(0, -left) : max(0, -left) + len(own)] = own
        lanes, of = np.unique(rows, axis=0, return_inverse=True)
        of = of.ravel()
        width = lanes.shape[1]
        sums, flat = running(lanes.ravel()), np.arange(lanes.size)
        score = np.full((deep + 1, lanes.size), _NONE)
        ids = np.full((deep + 1, lanes.size), -1, np.int32)
        score[1] = np.where(lanes.ravel() == _PAD, _NONE, pieces.fallback_scores(lanes.ravel()))
        for length in range(1, deep + 1):
            start = flat[flat % width <= width - length]
            found, at = pieces.probe(sums, start, length)
            score[length, start[found]], ids[length, start[found]] = pieces.scores[at], pieces.ids[at]
        score, ids = (np.ascontiguousarray(x.reshape(deep + 1, len(lanes), width).transpose(0, 2, 1)) for x in (score, ids))
        some = (score > _NONE).any(2)
        best = np.full((deep + step, deep, len(lanes)), _NONE)
        for e in range(deep):
            best[deep - 1 - e, e] = 0
        for t in range(deep, deep + step):
            for length in range(1, deep + 1):
                if some[length, t - length]:
                    np.maximum(best[t], best[t - length] + score[length, t - length], out=best[t])
        entry = np.full((deep + step, len(part)), _NONE)
        for r, (i, w) in enumerate(part):
            scores, counts = front[w]
            entry[deep - 1 :: -1, r] = scores
            n = min(step, len(codes[w]) - i * step)
            key = node[w], lanes[of[r]].tobytes(), n
            if key not in nodes:
                through = best[n : n + deep, :, of[r]][::-1]  # by place before the end, and place before the start
                total = scores + through
                pick = total.argmax(1)
                nodes[key] = len(nodes) + 1, (np.maximum(total.max(1), _NONE), counts[pick] + (-through[np.arange(deep), pick] & 1023))
            node[w], front[w] = nodes[key]
        if not spell:
            continue
        last = np.zeros((deep + step, len(part)), np.int8)
        for t in range(deep, deep + step):
            for length in range(deep, 0, -1):  # of equal sums the longest last piece
                if some[length, t - length]:
                    new = entry[t - length] + score[length, t - length, of]
                    better = new > entry[t]
                    np.copyto(entry[t], new, where=better)
                    last[t][better] = length
        for r, (i, w) in enumerate(part):
            n = min(step, len(codes[w]) - i * step)
            back = last[deep : deep + n, r].astype(np.int64)
            came[w][i * step + 1 : i * step + n + 1] = back
            via[w][i * step + 1 : i * step + n + 1] = ids[back, np.arange(deep, deep + n) - back, of[r]]
    if not spell:
        return [counts[:1] for _, counts in front]
    out = []
    for own, steps, last_ids in zip(codes, came, via, strict=True):
        i, found = len(own), []
        steps, last_ids = steps.tolist(), last_ids.tolist()
        while i:
            v = last_ids[i]
            found += [v] if v >= 0 else pieces.spelt(int(own[i - 1]))[::-1]
            i -= steps[i]
        out.append(np.array(found[::-1], np.int32))
    return out


class _Numbers(dict):
    """Numbers words as they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _numbered(numbers: _Numbers, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The pre-tokens of texts as numbers, how many each text has, and the words that are new."""
    known = len(numbers)
    lists = [pre_tokens(t) for t in texts]
    sizes = np.array([len(words) for words in lists], np.int64)
    rows = np.fromiter(map(numbers.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
    return rows, sizes, list(islice(numbers, known, None))


class Encoder:
    """Batched Viterbi: equal-length words advance together; a bounded memory of words spares repeats."""

    def __init__(self, pieces: Pieces, remember: int = 200_000):
        self.pieces, self.remember = pieces, remember
        self._forget()

    def _forget(self) -> None:
        self.words = _Numbers()
        self.flat, self.count, self.at = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after the other, and each text's number of ids."""
        if len(self.words) > self.remember:
            self._forget()
        rows, sizes, new = _numbered(self.words, texts)
        if new:
            flat, count = self._segment(new)
            self.at = np.concatenate((self.at, len(self.flat) + np.cumsum(count) - count))
            self.flat, self.count = np.concatenate((self.flat, flat)), np.concatenate((self.count, count))
        count = self.count[rows]
        ends = np.cumsum(count)
        ids = self.flat[np.repeat(self.at[rows] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.diff(np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes)))])

    def _segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, in order, and each word's number of ids."""
        lengths = np.array([len(w) for w in words])
        results: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # word numbers, ids flat, counts
        long = np.flatnonzero(lengths > STRETCH).tolist()
        for i, ids in zip(long, _long_words(self.pieces, [words[i] for i in long], spell=True), strict=True):
            results.append((np.array([i]), ids, np.array([len(ids)])))
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] <= STRETCH]
        ends = np.cumsum(lengths[order])
        a = 0
        while a < len(order):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + 60_000, side="right")))
            results += self._block(order[a:b], [words[i] for i in order[a:b]], lengths[order[a:b]])
            a = b
        number = np.concatenate([r[0] for r in results])
        count, flat = np.concatenate([r[2] for r in results]), np.concatenate([r[1] for r in results])
        start = np.cumsum(count) - count
        back = np.argsort(number, kind="stable")
        count, start = count[back], start[back]
        return flat[np.repeat(start - (np.cumsum(count) - count), count) + np.arange(len(flat))], count

    def _block(self, number: np.ndarray, words: list[str], lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        pieces = self.pieces
        codes = codes_of(words)
        sums = running(codes)
        first = np.cumsum(lengths) - lengths
        rest = np.repeat(first + lengths, lengths) - np.arange(len(codes))  # characters to the word's end
        longest = min(pieces.longest, int(lengths.max()))
        score = np.full((longest + 1, len(codes)), _NONE)
        ids = np.full((longest + 1, len(codes)), -1, np.int32)
        score[1] = pieces.fallback_scores(codes)
        for length in range(1, longest + 1):
            start = np.flatnonzero(rest >= length)
            found, at = pieces.probe(sums, start, length)
            score[length, start[found]], ids[length, start[found]] = pieces.scores[at], pieces.ids[at]
        for size in np.unique(lengths).tolist():
            group = np.flatnonzero(lengths == size)
            begin, n = first[group], len(group)
            # by length and start, a row over the group's words; most pairs of the two have no piece at all
            own = np.ascontiguousarray(score[:, begin[:, None] + np.arange(size)].transpose(0, 2, 1))
            some = (own > _NONE).any(2)
            best = np.full((size + 1, n), _NONE)
            came = np.zeros((size + 1, n), np.int8)
            best[0] = 0
            for t in range(1, size + 1):
                for length in range(min(longest, t), 0, -1):  # of equal sums the longest last piece
                    if some[length, t - length]:
                        new = best[t - length] + own[length, t - length]
                        better = new > best[t]
                        np.copyto(best[t], new, where=better)
                        came[t][better] = length
            tokens, have = np.zeros((size, n), np.int32), np.zeros((size, n), bool)
            place, row = np.full(n, size), np.arange(n)
            for k in range(size - 1, -1, -1):
                live = place > 0
                if not live.any():
                    break
                step = came[place, row].astype(np.int64)
                tokens[k] = np.where(live, ids[step, np.minimum(begin + place - step, len(codes) - 1)], 0)
                have[k] = live
                place = np.where(live, place - step, 0)
            flat, count = tokens.T[have.T], have.sum(0)
            if (flat < 0).any():
                ends = np.cumsum(count)
                out = []
                for i in range(n):
                    own = flat[ends[i] - count[i] : ends[i]].tolist()
                    if min(own) < 0:  # spell the characters without a piece
                        spelt, at = [], int(begin[i])
                        for v in own:
                            spelt += [v] if v >= 0 else pieces.spelt(int(codes[at]))
                            at += len(pieces.bytes[v].decode()) if v >= 0 else 1
                        own = spelt
                    out.append(own)
                flat, count = np.array([v for own in out for v in own], np.int32), np.array([len(own) for own in out])
            yield number[group], flat, count


class Counter:
    """Token counts of words: forward scores over a trie of the distinct words, one for each shared prefix."""

    def __init__(self, pieces: Pieces, remember: int = 200_000):
        self.pieces, self.remember = pieces, remember
        self.words = _Numbers()
        self.tokens = np.zeros(0, np.int64)

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and pre-tokens of each text."""
        if len(self.words) > self.remember:
            self.words, self.tokens = _Numbers(), np.zeros(0, np.int64)
        rows, sizes, new = _numbered(self.words, texts)
        if new:
            self.tokens = np.concatenate((self.tokens, self._trie(new)))
        sums = np.concatenate(([0], np.cumsum(self.tokens[rows])))
        return np.diff(sums[np.concatenate(([0], np.cumsum(sizes)))]), sizes

    def _trie(self, words: list[str]) -> np.ndarray:
        pieces = self.pieces
        out = np.zeros(len(words), np.int64)
        lengths = np.array([len(w) for w in words])
        long = np.flatnonzero(lengths > STRETCH)
        out[long] = np.concatenate([np.zeros(0, np.int64), *_long_words(pieces, [words[i] for i in long.tolist()], spell=False)])
        short = sorted(np.flatnonzero(lengths <= STRETCH).tolist(), key=words.__getitem__)
        for a in range(0, len(short), 20_000):
            number = np.array(short[a : a + 20_000])
            size = lengths[number]
            codes = codes_of([words[i] for i in number])
            first, sums, deep = np.cumsum(size) - size, running(codes), int(size.max())
            table = np.full((len(number), deep), -1)
            table[np.repeat(np.arange(len(number)), size), np.arange(len(codes)) - np.repeat(first, size)] = codes
            shared = np.zeros(len(number), np.int64)  # characters shared with the word before: nodes that exist already
            same = table[1:] == table[:-1]
            shared[1:] = np.minimum(np.where(same.all(1), deep, same.argmin(1)), np.minimum(size[1:], size[:-1]))
            # forward[d, i]: best score of the trie node at depth d on word i's path
            forward = np.full((deep + 1, len(number)), _NONE)
            forward[0] = 0
            index = np.arange(len(number))
            for d in range(1, deep + 1):
                node = np.flatnonzero((shared < d) & (size >= d))  # the node's first word stands for it
                value = forward[d - 1, node] + pieces.fallback_scores(codes[first[node] + d - 1])
                for length in range(1, min(pieces.longest, d) + 1):
                    found, at = pieces.probe(sums, first[node] + d - length, length)
                    new = forward[d - length, node[found]] + pieces.scores[at]
                    value[found] = np.where(length == 1, new, np.maximum(value[found], new))
                source = np.zeros(len(number), np.int64)
                source[node] = index[node]
                source = np.maximum.accumulate(source)
                full = np.full(len(number), _NONE)
                full[node] = value
                forward[d] = full[source]
            out[number] = -forward[size, index] & 1023  # terminal nodes
        return out
