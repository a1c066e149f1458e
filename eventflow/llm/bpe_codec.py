"""Operator 1: BPE encoding and decoding by speculating and verifying.

A word is first cut greedily into the longest vocabulary tokens. That guess is the right encoding
exactly if every adjacent pair of its tokens is compatible, that is, if no merge across their border
would have come first. All pairs of a batch are tested together; only words with a failing pair are
merged exactly, lowest rank first.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from eventflow.llm.common import append_columns
from eventflow.llm.text_units import UNSETTLED, spell, unspell

#: Words a Python worker remembers.
CACHE_WORDS = 150_000
#: Words of more symbols are merged one by one.
SHORT = 64
#: Rank of a pair that never merges.
NEVER = np.iinfo(np.int64).max
#: Moves a symbol out of the alphabet, to mark it as the last of its word.
LAST = 0x1000
#: Between words; in no token.
BREAK = "\uffff"


class Vocabulary:
    """Tokens, merges and the pair test of a BPE vocabulary with or without a word-end mark."""

    def __init__(self, tokens: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.tokens, self.end = tokens, end
        self.size = max(tokens.values()) + 1
        self.rank = np.full(self.size, -1, np.int64)
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            joined, ia, ib = tokens[a + b], tokens[a], tokens[b]
            if (ia, ib) not in self.pair:
                self.pair[ia, ib] = (rank, joined)
            if self.rank[joined] < 0:
                self.rank[joined], self.left[joined], self.right[joined] = rank, ia, ib
        keys = np.array([a * self.size + b for a, b in self.pair], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.pair.values()], np.int64)[order]
        self.made = np.zeros(len(merges), np.int64)
        for rank, joined in self.pair.values():
            self.made[rank] = joined
        self.symbols = np.zeros(self.size, np.int64)
        for text, i in tokens.items():
            ends = end and text.endswith(end) and len(text) > len(end)
            self.symbols[i] = len(text) - len(end) if ends else len(text)
        self._proposals()

    def _proposals(self) -> None:
        """Only tokens that encode to themselves may be proposed."""
        made = np.flatnonzero(self.rank >= 0)
        whole = np.ones(self.size, bool)
        whole[made] = self._unbroken(self.left[made], self.right[made], self.rank[made])
        for token in made[np.argsort(self.rank[made])]:
            whole[token] &= whole[self.left[token]] and whole[self.right[token]]
        self.proposals = ahocorasick.Automaton()
        for text, i in self.tokens.items():
            if whole[i]:
                ends = self.end and text.endswith(self.end) and len(text) > len(self.end)
                self.proposals.add_word(self._last(text[: -len(self.end)]) if ends else text, i)
        self.proposals.make_automaton()

    def _last(self, word: str) -> str:
        """The word with its last symbol marked as such, if the vocabulary tells it apart."""
        return word[:-1] + chr(ord(word[-1]) + LAST) if self.end else word

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.pair_keys):
            return np.full(len(a), NEVER)
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def _unbroken(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, skip_first: bool = True) -> np.ndarray:
        """Whether no merge across the border comes before both sides are complete.

        Goes back in time: of the two tokens at the border the later made one is split, and the merge
        of the new neighbours must not rank before the one undone (on a tie the left one comes first).
        """
        good = np.ones(len(a), bool)
        todo = np.arange(len(a))
        a, b, limit = a.copy(), b.copy(), limit.copy()
        first = skip_first
        while len(todo):
            if not first:
                ok = self._pair_rank(a, b) >= limit
                good[todo[~ok]] = False
                todo, a, b, limit = todo[ok], a[ok], b[ok], limit[ok]
            first = False
            ra, rb = self.rank[a], self.rank[b]
            more = (ra >= 0) | (rb >= 0)
            todo, a, b, limit, ra, rb = (x[more] for x in (todo, a, b, limit, ra, rb))
            undo_left = ra > rb
            limit = np.where(undo_left, ra, rb + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return good

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens stays as it is when its text is encoded."""
        return self._unbroken(a, b, np.full(len(a), NEVER), skip_first=False)

    def greedy(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Longest tokens from the left, for all words at once: the tokens, and the word of each."""
        joined = BREAK.join(map(self._last, words))
        found = np.array(list(self.proposals.iter_long(joined)), np.int64).reshape(-1, 2)
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        return found[:, 1], np.searchsorted(stops, found[:, 0])

    def merge(self, word: str) -> list[int]:
        """Exact BPE: the pair of lowest rank first, of equal ones the leftmost. n log n."""
        parts = list(word)
        parts[-1] += self.end
        ids = [self.tokens[p] for p in parts]
        n = len(ids)
        after, before = list(range(1, n)) + [-1], list(range(-1, n - 1))
        heap = [(self.pair[p][0], i, p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in self.pair]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] != pair[0] or j < 0 or ids[j] != pair[1]:
                continue
            ids[i], ids[j] = self.pair[pair][1], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (p := (ids[k], ids[after[k]])) in self.pair:
                    heapq.heappush(heap, (self.pair[p][0], k, p))
        return [i for i in ids if i >= 0]

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """Exact BPE of many short words: each round does every word's first pair of lowest rank."""
        out: list[list[int]] = [[]] * len(words)
        tokens, end = self.tokens, self.end
        ids = np.array([tokens[p] for w in words for p in (*w[:-1], w[-1] + end)], np.int64)
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        rank = self._ranks(ids, word)
        while len(ids):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, first)
            done = best == NEVER
            if done.any():
                sizes = np.diff(np.append(first, len(ids)))
                gone = np.repeat(done, sizes)
                for w, part in zip(word[first[done]].tolist(), _lists(ids[gone], sizes[done])):
                    out[w] = part
                ids, word, rank = ids[~gone], word[~gone], rank[~gone]
                first, best = first[~done] - np.cumsum(sizes * done)[~done], best[~done]
                if not len(ids):
                    break
            hits = np.flatnonzero(rank == np.repeat(best, np.diff(np.append(first, len(ids)))))
            at = hits[np.concatenate([[True], word[hits[1:]] != word[hits[:-1]]])]
            ids[at] = self.made[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, word, rank = ids[keep], word[keep], rank[keep]
            at = at - np.arange(len(at))
            for place in (at, at[at > 0] - 1):
                rank[place] = self._ranks(ids, word, place)
        return out

    def _ranks(self, ids: np.ndarray, word: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Rank of the merge of each symbol with the next one of its word."""
        at = np.arange(len(ids)) if at is None else at
        after = np.minimum(at + 1, len(ids) - 1)
        return np.where((word[after] == word[at]) & (after > at), self._pair_rank(ids[at], ids[after]), NEVER)

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Greedy guesses for all words, one test of all their pairs, exact merges for what failed."""
        flat, owner = self.greedy(words)
        bad = np.zeros(len(words), bool)
        inside = owner[1:] == owner[:-1]
        failing = ~self.compatible(flat[:-1][inside], flat[1:][inside])
        bad[owner[1:][inside][failing]] = True
        sizes = np.bincount(owner, minlength=len(words))
        covered = np.bincount(owner, weights=self.symbols[flat], minlength=len(words))
        bad |= covered != np.fromiter(map(len, words), np.int64, len(words))
        out = dict(zip(words, _lists(flat, sizes)))
        wrong = [words[i] for i in np.flatnonzero(bad)]
        short = [w for w in wrong if len(w) <= SHORT]
        out.update(zip(short, self.merge_all(short)))
        out.update((w, self.merge(w)) for w in wrong if len(w) > SHORT)
        return out


def _lists(flat: np.ndarray, sizes: np.ndarray) -> Iterator[list[int]]:
    values, stops = flat.tolist(), np.cumsum(sizes).tolist()
    return (values[a:b] for a, b in zip([0, *stops], stops))


class Codec:
    """Encoding and decoding as the given tokenizer file says.

    The file names a normalizer (NFC, white space to one blank, lower case), a splitting pattern over
    bytes, special tokens that are cut out of the raw text, and a word-end mark.
    """

    def __init__(self, definition: bytes):
        spec = json.loads(definition)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.vocabulary = Vocabulary(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        for general, plain in (r"\p{L}", "A-Za-z"), (r"\p{N}", "0-9"), (r"\s", r"\t\n\v\f\r "):
            pattern = pattern.replace(general, plain)
        self.ascii_pattern = re.compile(pattern)  # the same for ASCII; the file has its classes in brackets
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.library = Tokenizer.from_str(definition.decode())
        self.table = [""] * (max([self.vocabulary.size - 1, *self.special.values()]) + 1)
        for text, i in {**model["vocab"], **self.special}.items():
            self.table[i] = text
        self._forget()

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens, in normal form."""
        if text.isascii():
            return self.ascii_pattern.findall(text.lower())
        if UNSETTLED.search(text):
            normal = self.library.normalizer.normalize_str(text)
            spelled = self.library.pre_tokenizer.pre_tokenize_str(normal)
            return [unspell(w) for w, _ in spelled]
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case regardless of context
        return self.pattern.findall(text.lower())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's ids start and end."""
        found: list[str] = []
        ends = [0]
        for text in texts:
            for piece in self.cut.split(text) if self.cut and "<|" in text else [text]:
                if piece in self.special:
                    found.append(piece)
                else:
                    found += self.words(piece)
            ends.append(len(found))
        slots = self._slots(found)
        sizes, starts = self.sizes[slots], self.starts[slots]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(starts - stops[:-1], sizes) + np.arange(stops[-1])]
        return ids, stops[ends].astype(np.int32)

    def _forget(self) -> None:
        """Back to the special tokens alone; they are no words, so they share the table with them."""
        self.slot: dict[str, int] = {t: i for i, t in enumerate(self.special)}
        self.ids = np.array(list(self.special.values()), np.int32)
        self.starts = np.arange(len(self.ids))
        self.sizes = np.ones(len(self.ids), np.int64)

    def _slots(self, words: list[str]) -> np.ndarray:
        """The place of each word in the table of remembered words, which is filled as needed."""
        distinct = set(words)
        unseen = [w for w in distinct if w not in self.slot]
        if len(self.slot) + len(unseen) > CACHE_WORDS:
            self._forget()
            unseen = [w for w in distinct if w not in self.slot]
        if unseen:
            spelled = [w if w.isascii() and w.isprintable() else spell(w) for w in unseen]
            ids = self.vocabulary.encode_words(spelled)
            lists = [ids[s] for s in spelled]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            self.slot.update(zip(unseen, range(len(self.sizes), len(self.sizes) + len(unseen))))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))])
        return np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))

    def decode(self, ids: np.ndarray, stops: np.ndarray) -> list[str]:
        """The tokens' strings joined by blanks, word-end marks included: the file names no decoder."""
        tokens, stops = list(map(self.table.__getitem__, ids.tolist())), stops.tolist()
        return [" ".join(tokens[a:b]) for a, b in zip(stops, stops[1:])]


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with the token ids of the whole text, an array of int.

    Null and empty texts have no ids. Texts of any length are encoded whole. Rows are independent:
    ties and repeated rows keep their own results, an empty table stays empty, and an input column
    named as `ids` is replaced; all others stay.
    """
    definition = _shared(df, path)

    def start():
        codec = Codec(definition.value)

        def work(batch):
            values, stops = codec.encode([t or "" for t in batch.column(text).to_pylist()])
            return {ids: pa.ListArray.from_arrays(stops, values)}

        return work

    return append_columns(df, start, f"`{ids}` array<int>")


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df with the text of the ids, special tokens included; null or no ids give the empty text."""
    definition = _shared(df, path)

    def start():
        codec = Codec(definition.value)

        def work(batch):
            lists = batch.column(ids)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            return {text: codec.decode(lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)]))}

        return work

    return append_columns(df, start, f"`{text}` string")


def _shared(df: DataFrame, path: str):
    """The tokenizer file, a few MB whatever the corpus, read on the driver."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())
