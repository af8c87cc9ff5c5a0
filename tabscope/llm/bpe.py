"""BPE encoding by speculation: propose by longest match, verify every adjacent pair."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tabscope.llm.batches import chunks, texts

# fixed values: the suffix of a word's last symbol; letters and numbers below code point 768,
# where lower case is one character for one and nothing composes
END = "</w>"
LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02c1\u02c6-\u02d1\u02e0-\u02e4\u02ec\u02ee"
NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
WORDS = f"[{LETTERS}]+|[{NUMBERS}]|'(?:s|t|re|ve|m|ll|d)|[^{LETTERS}{NUMBERS}]+"
BLANK = re.compile(r"[ \n\t]+")
FIRST_LATE_BYTE = 0xCC  # of code point 768 in UTF-8
SLICE_CHARS = 1 << 18  # text that is cut into pieces at a time, up to the next white space
SEGMENT = 1 << 15  # pieces that are looked up at a time
BATCH_BYTES = 1 << 20  # text of the rows whose ids are built at a time
# what a worker remembers, forgotten as a whole when it gets over one of these
CACHE_PIECES, CACHE_CHARS, CACHE_PAIRS = 1 << 19, 1 << 23, 1 << 18


def byte_symbols() -> list[str]:
    """The printable character that byte-level tokenizers write for each byte: itself where it
    is visible in Latin-1, else the next free character from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    symbols, free = [], 256
    for byte in range(256):
        if byte in visible:
            symbols.append(chr(byte))
        else:
            symbols.append(chr(free))
            free += 1
    return symbols


class Encoder:
    """Encodes words of one byte-level BPE vocabulary with word ends.

    A segmentation is the one that merging gives if each token is what its own text merges to
    and no adjacent pair of tokens would have been merged across their border. Both are
    decided from the merge table: along the right edge of the left token and the left edge of
    the right one, a border merge takes place if it ranks before the merges that swallow the
    two symbols (on a tie the leftmost merge goes first).
    """

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        # only the library's normalizer and cutting into words are used, so it gets no vocabulary
        self.library = Tokenizer.from_str(json.dumps(spec | {"model": model | {"vocab": {}, "merges": []}, "added_tokens": []}))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.vocab: dict[str, int] = model["vocab"]
        names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.size = max(names) + 1
        self.names = pa.array([names.get(i) for i in range(self.size)], pa.string())
        self.symbols = byte_symbols()
        self.reach: dict[str, int] = {}  # longest token that starts with two given symbols
        for token in self.vocab:
            text = token.removesuffix(END)
            self.reach[text[:2]] = max(len(text), self.reach.get(text[:2], 1))
        self.find = re.compile(WORDS).findall
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        pairs = [m if isinstance(m, (list, tuple)) else m.split(" ") for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        codes = left * self.size + right
        self.ranks = dict(zip(codes.tolist(), range(len(pairs))))
        self.made = made.tolist()
        order = np.argsort(codes, kind="stable")
        self.codes, self.code_rank = codes[order], order
        self.rank = np.full(self.size, -1, np.int64)  # of the merge that makes the token
        self.rank[made] = np.arange(len(made))
        self.left_edge = self._edge(made, left)
        self.right_edge = self._edge(made, right)
        # a merged token stands for its text if its two parts do and meet only in its own merge
        good = np.ones(self.size, bool)
        good[made] = ~self._crossed(left, right, own=True)
        for a, b, c in zip(left, right, made):  # in the order of the merges
            good[c] &= good[a] & good[b]
        self.good = good
        self.bytes_of = {symbol: b for b, symbol in enumerate(self.symbols)}
        self.forget()

    def forget(self) -> None:
        """Empties the caches: the numbers of texts between white space and of words, the ids of each
        number, one after the other, and the answers about pairs."""
        self.pieces: dict[str | tuple[str], int] = {}
        self.ends = np.zeros(1, np.int64)  # of each number's ids, after a zero; filled as far as there are pieces
        self.flat = np.empty(0, np.int32)
        self.chars = 0  # of all pieces
        self.known, self.known_ok = np.empty(0, np.int64), np.empty(0, bool)

    def remember(self, pieces: list[str | tuple[str]], ids: list[list[int]]) -> None:
        """Numbers new pieces with their ids; the arrays double when they are full."""
        first, used = len(self.pieces), int(self.ends[len(self.pieces)])
        ends = used + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        self.ends = _room(self.ends, first + len(pieces) + 1)
        self.ends[first + 1 : first + len(pieces) + 1] = ends
        last = int(ends[-1]) if len(ends) else used
        self.flat = _room(self.flat, last)
        self.flat[used:last] = np.fromiter(chain.from_iterable(ids), np.int32, last - used)
        self.pieces.update(zip(pieces, range(first, first + len(pieces))))
        self.chars += sum(len(p) if isinstance(p, str) else len(p[0]) for p in pieces)

    def full(self) -> bool:
        return len(self.pieces) > CACHE_PIECES or self.chars > CACHE_CHARS or len(self.known) > CACHE_PAIRS

    def _edge(self, made: np.ndarray, part: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per depth: the symbol on the token's edge, and the rank of the merge that swallows it."""
        child = np.full(self.size, -1, np.int64)
        child[made] = part
        at, swallowed = np.arange(self.size), np.full(self.size, 1 << 40, np.int64)
        levels = []
        while (at >= 0).any():
            levels.append((at, swallowed))
            there = at >= 0
            swallowed = np.where(there, self.rank[at], -1)
            at = np.where(there, child[at], -1)
        return levels

    def _crossed(self, left: np.ndarray, right: np.ndarray, own: bool = False) -> np.ndarray:
        """Whether merging would cross the border between two tokens.

        own: do not count the merge of the whole tokens.
        """
        crossed = np.zeros(len(left), bool)
        for i, (edge, swallowed) in enumerate(self.right_edge):
            rows = np.flatnonzero(edge[left] >= 0)
            for j, (other, other_swallowed) in enumerate(self.left_edge):
                if own and i == 0 and j == 0:
                    continue
                here = rows[other[right[rows]] >= 0]
                if not len(here):
                    break
                code = edge[left[here]] * self.size + other[right[here]]
                place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
                rank = self.code_rank[place]
                first = (rank < swallowed[left[here]]) & (rank <= other_swallowed[right[here]])
                crossed[here[(self.codes[place] == code) & first]] = True
        return crossed

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens may stand side by side; answers are remembered."""
        codes, back = np.unique(left * self.size + right, return_inverse=True)
        place = np.minimum(np.searchsorted(self.known, codes), max(len(self.known) - 1, 0))
        new = codes[self.known[place] != codes] if len(self.known) else codes
        if len(new):
            ok = ~self._crossed(new // self.size, new % self.size)
            known = np.concatenate([self.known, new])
            order = np.argsort(known, kind="stable")
            self.known, self.known_ok = known[order], np.concatenate([self.known_ok, ok])[order]
        return self.known_ok[np.searchsorted(self.known, codes)][back]

    def propose(self, word: str) -> list[int]:
        """Greedy longest match over the symbols of a word."""
        ids, start, n, vocab, reach = [], 0, len(word), self.vocab, self.reach
        while start < n:
            end = min(n, start + reach.get(word[start : start + 2], 1))
            while True:
                token = vocab.get(word[start:] + END if end == n else word[start:end])
                if token is not None:
                    break
                end -= 1
                if end == start:
                    raise ValueError(f"no token for {word[start]!r}")
            ids.append(token)
            start = end
        return ids

    def merge(self, word: str) -> list[int]:
        """Exact merging, lowest rank first, leftmost first: a heap over linked symbols."""
        ids = [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + END]]
        get, size, made, never = self.ranks.get, self.size, self.made, len(self.made)
        if len(ids) > 64:
            return self._merge_long(ids)
        ranks = [get(a * size + b, never) for a, b in zip(ids, ids[1:])]
        while ranks and (low := min(ranks)) < never:
            i = ranks.index(low)
            ids[i : i + 2] = [made[low]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(ids[i] * size + ids[i + 1], never)
            if i:
                ranks[i - 1] = get(ids[i - 1] * size + ids[i], never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over linked symbols."""
        after, before, heap = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)], []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (rank := self.ranks.get(ids[i] * self.size + ids[j])) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.made[rank], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]

    def ids_of(self, words: list[str]) -> list[list[int]]:
        """The ids of words: propose all, verify all pairs, merge the rest."""
        symbol = self.symbols
        spelled = [w if w.isascii() and w.isalnum() else "".join([symbol[b] for b in w.encode()]) for w in words]
        proposed = [self.propose(s) for s in spelled]
        counts = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(counts.sum()))
        owner = np.repeat(np.arange(len(words)), counts)
        failing = np.zeros(len(words), bool)
        failing[owner[~self.good[flat]]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        if len(inner):
            fine = self.compatible(flat[inner], flat[inner + 1])
            failing[owner[inner[~fine]]] = True
        for k in np.flatnonzero(failing):
            proposed[k] = self.merge(spelled[k])
        return proposed

    def learn(self, pieces: list[str | tuple[str]]) -> None:
        """Numbers new pieces. A string is text that is still to be cut into words, a tuple holds
        one word, or one special token, as it is. A word is a piece of its own as well."""
        special = [p for p in pieces if isinstance(p, tuple) and p[0] in self.special]
        self.remember(special, [[self.special[p[0]]] for p in special])
        rest = [p for p in pieces if p not in self.pieces]
        cut = [p if isinstance(p, tuple) else self.find(p) for p in rest]
        new = list(set(chain.from_iterable(cut)).difference(self.pieces))
        self.remember(new, self.ids_of(new))
        more, ids, flat, ends, number = [], [], self.flat, self.ends, self.pieces
        for piece, words in zip(rest, cut):
            if piece not in number:
                more.append(piece)
                ids.append([x for w in words for x in flat[ends[number[w]] : ends[number[w] + 1]].tolist()])
        self.remember(more, ids)

    def split(self, text: str) -> list[str | tuple[str]]:
        """The pieces of a text. Words never cross white space, so text that is lower-cased
        character by character is cut there; any other text, and one with the control characters that
        only Python takes for white space, is cut into words by the tokenizers library."""
        if self.cut and "<|" in text:
            parts = self.cut(text)
            return [w for k, part in enumerate(parts) for w in ([(part,)] if k % 2 else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str | tuple[str]]:
        seen = np.frombuffer(text.encode(), np.uint8)
        if len(seen) == 0:
            return []
        if seen.max() < FIRST_LATE_BYTE and not ((seen >= 0x1C) & (seen <= 0x1F)).any():
            return text.lower().split()
        clean = self.library.normalizer.normalize_str(text)
        cut, bytes_of = self.library.pre_tokenizer.pre_tokenize_str(clean), self.bytes_of
        return [(bytes(bytes_of[c] for c in w).decode(),) for w, _ in cut]

    def segments(self, batch: list[str]) -> Iterator[tuple[list[str | tuple[str]], list[int]]]:
        """The pieces of all texts in lists of bounded length, and of each list how many belong to each
        text. Long texts are cut at white space, which no piece crosses, before they are cut into pieces."""
        pieces, counts = [], [0] * len(batch)
        for k, text in enumerate(batch):
            start = 0
            while start < len(text):
                end = start + SLICE_CHARS
                if end < len(text):
                    space = BLANK.search(text, end)
                    end = space.end() if space else len(text)
                cut = self.split(text[start:end])
                for at in range(0, len(cut), SEGMENT):
                    some = cut[at : at + SEGMENT]
                    pieces += some
                    counts[k] += len(some)
                    if len(pieces) >= SEGMENT:
                        yield pieces, counts
                        pieces, counts = [], [0] * len(batch)
                start = end
        yield pieces, counts

    def numbered(self, pieces: list[str | tuple[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each piece, and all their ids."""
        if self.full():
            self.forget()
        new = set(pieces).difference(self.pieces)
        if new:
            self.learn(list(new))
        own = np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))
        counts = self.ends[own + 1] - self.ends[own]
        stops = np.cumsum(counts)
        place = np.repeat(self.ends[own] - (stops - counts), counts) + np.arange(int(counts.sum()))
        return counts, self.flat[place]

    def encode(self, batch: list[str], decode: bool = True) -> tuple[pa.ListArray, pa.StringArray | None]:
        """Token ids of each text, and if wanted the text that the library decodes from them: as the
        vocabulary has no decoder, the tokens' names with spaces between."""
        sizes, parts = np.zeros(len(batch), np.int64), [np.empty(0, np.int32)]
        for pieces, per_text in self.segments(batch):
            counts, ids = self.numbered(pieces)
            parts.append(ids)
            sizes += np.bincount(np.repeat(np.arange(len(batch)), per_text), counts, len(batch)).astype(np.int64)
        offsets = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
        ids = pa.array(np.concatenate(parts))
        decoded = pc.binary_join(pa.ListArray.from_arrays(offsets, self.names.take(ids)), " ") if decode else None
        return pa.ListArray.from_arrays(offsets, ids), decoded


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, in a longer one if it has less than ``size`` places."""
    if size <= len(array):
        return array
    longer = np.empty(max(size, 2 * len(array)), array.dtype)
    longer[: len(array)] = array
    return longer


def encode(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True
) -> DataFrame:
    """Rows (id, ids, decoded) for every document: whole texts, null as empty.

    The vocabulary file is read on the driver and sent to the tasks, so only the driver needs
    it; it does not grow with the data. There is no shuffle. A worker keeps what it has met of words, pieces
    and pairs up to fixed numbers and an amount of text, which are checked every SEGMENT pieces, and builds the
    ids of BATCH_BYTES of text at a time. A longer text is one batch, read in slices: besides the text, its ids and
    its decoded text nothing grows with it, but for a single word of many megabytes, which is merged in one go.
    An empty text, or one of white space, has no ids. Repeated rows are encoded alike. Without ``decode`` there is
    no decoded text to build and that column is left out. Columns other than the two are not read.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast([file.read()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = vocabulary.value  # a worker keeps its copy, and the encoder in it, from task to task
        for batch in chunks(batches, "text", BATCH_BYTES):
            if isinstance(kept[0], str):
                kept[0] = Encoder(kept[0])
            columns = [batch.column("id"), *kept[0].encode(texts(batch, "text"), decode)]
            names = ["id", "ids", "decoded"] if decode else ["id", "ids"]
            yield pa.RecordBatch.from_arrays(columns[: len(names)], names)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return rows.mapInArrow(run, f"id {kind}, ids array<int>" + ", decoded string" * decode)
