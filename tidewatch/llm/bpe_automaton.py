"""BPE encoding and decoding with an automaton over tokens, compiled from the merges.

The automaton reads tokens: after token t it stands in state S(t), and an arc x may follow when the
tokenizer can put x right behind t. It starts as one state with an arc for each byte. Merges are
taken in order, and the gadget for "u, v become w" changes three things:

    w arcs     every state with an arc u gets an arc w;
    S(w)       is a copy of S(v) as it stands before this merge;
    S(u)       loses its arc v, so that u, v side by side is no path any more.

After the last merge every text has exactly one path, and that path is its tokenization. The states
are never written out (50,000 states with 50,000 arcs each): a gadget is one row of tables, kept as
copy on write. `born` is a token's merge, `left` and `right` its parts, `lost` the sorted (u, v) that
a state has lost. Whether S(t) has arc x is looked up by following the younger of the two back
to what it was copied or widened from (`follows`), for many pairs at once.

Encoding a word (a run that the tokenizer's own splitter leaves whole) goes from left to right:
for each prefix there is one last token, the only arc that ends there, spells the end of the prefix
and leaves the state in which an earlier prefix ended. Arcs that spell parts of a word come from a
table over (node, byte). Short words go through the tables together, place by place; long ones
one by one. Each worker remembers the words of its pieces. Decoding writes out arc labels.

Memory: a chunk of text, its arcs, and the remembered pieces (bounded in `tokens`); work is linear
in the text for tokens of bounded length.

Null text counts as empty and gives no ids. Repeated rows and null ids are encoded like any other.
Special tokens spelled in a text become their ids, as the library does. Files with a normaliser,
merges that make a token twice, or parts younger than what they make are refused.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidewatch.llm.common import importable, keyed, text_chunks
from tidewatch.llm.tokens import Encoder

#: Longest word (bytes) that goes through the tables together with others.
SHORT = 64
#: Bytes of new words that go through the tables at once.
TOGETHER = 1 << 20


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, by a rule: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Automaton:
    """Gadget tables of a list of merges; tokens are numbered bytes first, then merges in order."""

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        number = {bytes([b]): b for b in range(256)}
        self.labels = [bytes([b]) for b in range(256)]
        pairs = np.zeros((len(merges), 2), np.int64)
        for k, (u, v) in enumerate(merges):
            if u not in number or v not in number or u + v in number:
                raise ValueError(f"merge {k} uses a part before it is made, or makes a token again")
            pairs[k] = number[u], number[v]
            number[u + v] = len(self.labels)
            self.labels.append(u + v)
        self.number, self.size = number, len(self.labels)
        own = np.arange(256)
        self.left, self.right = np.concatenate([own, pairs[:, 0]]), np.concatenate([own, pairs[:, 1]])
        self.born = np.concatenate([np.zeros(256, np.int64), np.arange(1, len(merges) + 1)])
        keys = pairs[:, 0] * self.size + pairs[:, 1]
        order = np.argsort(keys)
        self.lost, self.lost_at = keys[order], self.born[256:][order]
        # A merge whose parts never stand side by side adds no arc; nor does one made of such a token.
        useful = np.ones(self.size, bool)
        useful[256:] = self.follows(pairs[:, 0], pairs[:, 1], self.born[256:] - 1)
        while (fell := useful[256:] & ~useful[pairs].all(axis=1)).any():
            useful[256:] &= ~fell
        self._spell([t for t in range(self.size) if useful[t]])

    def follows(self, t: np.ndarray, x: np.ndarray, when: np.ndarray | None = None) -> np.ndarray:
        """Whether state S(t) has arc x after merge `when` (after all merges if not given)."""
        answer = np.ones(len(t), bool)
        when = np.full(len(t), self.size) if when is None else when
        open_, t, x = np.arange(len(t)), np.array(t), np.array(x)
        while len(open_):
            if len(self.lost):
                key = t * self.size + x
                at = np.minimum(np.searchsorted(self.lost, key), len(self.lost) - 1)
                gone = (self.lost[at] == key) & (self.lost_at[at] <= when)
                answer[open_[gone]] = False
            else:
                gone = np.zeros(len(t), bool)
            on = ~gone & ((t >= 256) | (x >= 256))
            open_, t, x = open_[on], t[on], x[on]
            born_t, born_x = self.born[t], self.born[x]
            copied, widened = born_t >= born_x, born_x >= born_t
            t, x = np.where(copied, self.right[t], t), np.where(widened, self.left[x], x)
            when = np.where(copied, born_t - 1, born_x)
        return answer

    def _spell(self, tokens: list[int]) -> None:
        """Table (node, byte) -> node over the labels, and the token that ends in each node."""
        step: dict[int, int] = {}
        ends, nodes = {}, 1
        for t in tokens:
            node = 0
            for b in self.labels[t]:
                key = node << 8 | b
                node = step.get(key, 0)
                if not node:
                    node = step[key] = nodes
                    nodes += 1
            ends[node] = t
        self.step, self.ends = step, ends
        self.keys = np.fromiter(step, np.int64, len(step))
        order = np.argsort(self.keys)
        self.keys, self.next = self.keys[order], np.fromiter(step.values(), np.int64, len(step))[order]
        self.token = np.full(nodes, -1, np.int64)
        self.token[list(ends)] = list(ends.values())
        self.known: dict[int, bool] = {}

    def _arcs(self, data: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All arcs that spell a part of `data` and end at `stop` of their begin at the latest: begin, end, token."""
        begin = at = np.arange(len(data))
        node, found = np.zeros(len(data), np.int64), []
        while len(begin):
            key = node << 8 | data[at]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[place] == key
            begin, at, node = begin[on], at[on] + 1, self.next[place[on]]
            token = self.token[node]
            found.append((begin[token >= 0], at[token >= 0], token[token >= 0]))
            on = at < stop[begin]
            begin, at, node = begin[on], at[on], node[on]
        return tuple(np.concatenate(x) for x in zip(*found))

    def many(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The last token of every prefix of every word (`bounds` cut `data` into words)."""
        size = np.diff(bounds)
        head = np.repeat(bounds[:-1], size)
        begin, end, token = self._arcs(data, np.repeat(bounds[1:], size))
        place = end - head[begin]
        order = np.argsort(place, kind="stable")
        begin, end, token = begin[order], end[order], token[order]
        cuts = np.searchsorted(place[order], np.arange(1, (size.max() if len(size) else 0) + 2))
        last = np.full(len(data) + 1, -1, np.int64)  # by the place after the prefix
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            b, e, t = begin[lo:hi], end[lo:hi], token[lo:hi]
            first = b == head[b]
            last[e[first]] = t[first]
            b, e, t = b[~first], e[~first], t[~first]
            fits = self.follows(last[b], t)
            last[e[fits]] = t[fits]
        return last

    def one(self, word: bytes) -> list[int]:
        """The same for a long word, and its path: arcs are looked up as they are met."""
        size, fits = self.size, self.known
        if len(fits) > 1 << 20:
            fits.clear()
        step, ends, last = self.step, self.ends, [-1] * (len(word) + 1)
        for begin in range(len(word)):
            before, node = last[begin], 0
            for at in range(begin, len(word)):
                node = step.get(node << 8 | word[at])
                if node is None:
                    break
                token = ends.get(node)
                if token is None or last[at + 1] >= 0:
                    continue
                if before >= 0:
                    key = before * size + token
                    ok = fits.get(key)
                    if ok is None:
                        ok = fits[key] = bool(self.follows(np.array([before]), np.array([token]))[0])
                    if not ok:
                        continue
                last[at + 1] = token
        path, at = [], len(word)
        while at:
            path.append(last[at])
            at -= len(self.labels[last[at]])
        return path[::-1]

    def paths(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The paths of all words one after the other, and where each one begins, one more at the end."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        long = {k: self.one(words[k]) for k in np.flatnonzero(lengths > SHORT).tolist()}
        short = np.flatnonzero((lengths > 0) & (lengths <= SHORT))
        short = short[np.argsort(lengths[short], kind="stable")]
        width, count = np.fromiter(map(len, self.labels), np.int64, self.size), np.zeros(len(words), np.int64)
        count[list(long)] = [len(path) for path in long.values()]
        found = []
        for lo in range(0, len(short), TOGETHER // SHORT):
            part = short[lo : lo + TOGETHER // SHORT]
            bounds = np.concatenate([[0], np.cumsum(lengths[part])])
            last = self.many(np.frombuffer(b"".join([words[k] for k in part.tolist()]), np.uint8).astype(np.int64), bounds)
            # Back along the paths, all words at once.
            row, at = np.arange(len(part)), bounds[1:]
            while len(row):
                token = last[at]
                found.append((part[row], token, count[part[row]]))
                count[part[row]] += 1
                at = at - width[token]
                row, at = row[at > bounds[row]], at[at > bounds[row]]
        begin = np.concatenate([[0], np.cumsum(count)])
        out = np.zeros(begin[-1], np.int64)
        for word, token, back in found:
            out[begin[word + 1] - 1 - back] = token
        for k, path in long.items():
            out[begin[k] : begin[k + 1]] = path
        return out, begin


def gathered(values: np.ndarray, begin: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges `which` of `values` (cut by `begin`) one after the other, and where each ends."""
    size = begin[which + 1] - begin[which]
    ends = np.cumsum(size)
    return values[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin[which] - (ends - size), size)], ends


class AutomatonEncoder(Encoder):
    """Pieces as in `tokens`, split by the tokenizer's own splitter and encoded by the automaton."""

    workers: dict[str, "AutomatonEncoder"] = {}

    def __init__(self, path: str):
        super().__init__(path)
        spec = json.loads(self.tokenizer.to_str())
        if spec["normalizer"] is not None or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a byte-level vocabulary without normaliser is needed")
        self.letters = byte_letters()
        raw = lambda s: bytes(self.letters[c] for c in s)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.automaton = Automaton([(raw(u), raw(v)) for u, v in merges])
        vocabulary = spec["model"]["vocab"]
        ids = {raw(s): i for s, i in vocabulary.items()}
        self.id_of = np.array([ids[label] for label in self.automaton.labels], np.uint32)
        self.added = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items()}

    @classmethod
    def of(cls, path: str) -> "AutomatonEncoder":
        if path not in cls.workers:
            cls.workers[path] = cls(path)
        return cls.workers[path]

    def _words(self, piece: bytes) -> list[bytes]:
        letters = self.letters
        return [bytes([letters[c] for c in word]) for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece.decode())]

    def _learn(self, new: pa.Array) -> None:
        whole = pc.match_substring_regex(new.cast(pa.large_string()), "^ ?[A-Za-z]+$").to_numpy(zero_copy_only=False)
        words = [[piece] if one else self._words(piece) for piece, one in zip(new.to_pylist(), whole.tolist())]
        number: dict[bytes, int] = {}
        which = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), np.int64)
        last = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        tokens, ends = gathered(*self.automaton.paths(list(number)), which)
        self.pieces = pa.concat_arrays([self.pieces, new])
        self.begin = np.concatenate([self.begin, np.concatenate([[0], ends])[last] + self.begin[-1]])
        self.ids = np.concatenate([self.ids, self.id_of[tokens]])

    def _encode_one_by_one(self, raw: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts in which special tokens are spelled: the stretches between them are texts of their own.

        Each special token becomes a stretch of one byte, whose id is then put right; one more such
        stretch parts each text from the next, and its id goes.
        """
        spelled = re.compile(b"|".join(re.escape(s) for s in sorted(self.added, key=len, reverse=True)))
        parts, special, parting = [], {}, []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            text, done = raw[a:b], a
            for m in spelled.finditer(text):
                special[len(parts) + 1] = self.added[m[0]]
                parts += [raw[done : a + m.start()], b"\0"]
                done = a + m.end()
            parting.append(len(parts) + 1)
            parts += [raw[done:b], b"\0"]
        cuts = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
        ids, bounds = self.encode(np.frombuffer(b"".join(parts), np.uint8), cuts)
        ids, last = ids.copy(), bounds[parting]
        for k, i in special.items():
            ids[bounds[k]] = i
        return np.delete(ids, last), np.concatenate([[0], last - np.arange(len(last))])


class Labels:
    """Byte strings by number, written out for many numbers at once."""

    def __init__(self, labels: list[bytes]):
        self.data = np.frombuffer(b"".join(labels), np.uint8)
        self.begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, labels), np.int64, len(labels)))])

    def written(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The labels of `ids` one after the other, and where those of each text begin."""
        raw, ends = gathered(self.data, self.begin, ids)
        return raw.tobytes(), np.concatenate([[0], ends])[bounds]


    @staticmethod
    @cache
    def of(path: str) -> "Labels":
        """The arc labels of a vocabulary file by id; an id without one has none to write."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        labels = {i: bytes(letters[c] for c in s) for s, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        return Labels([labels.get(i, b"") for i in range(max(labels) + 1)])

    @staticmethod
    @cache
    def decimal(size: int) -> "Labels":
        return Labels([b"%d," % i for i in range(size)])

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        raw, cuts = self.written(ids, bounds)
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (unsigned 32-bit little-endian) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = AutomatonEncoder.of(path)
        for rows, data, at in text_chunks(batches):
            ids, bounds = encoder.encode(data, at)
            packed = pa.Array.from_buffers(pa.large_binary(), rows.num_rows, [None, pa.py_buffer(np.ascontiguousarray(bounds * 4, np.int64)), pa.py_buffer(ids.astype("<u4").tobytes())])
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), packed.cast(pa.binary())], ["doc_id", "ids"])

    return keyed(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of `encoded` (doc_id, ids) with the text their ids spell; bytes that are no UTF-8 become U+FFFD."""
    importable(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = Labels.of(path)
        for rows, ids, at in id_chunks(batches):
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(labels.texts(ids, at), pa.string())], ["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, text string")


def id_chunks(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of rows holding about `size` ids: (rows, ids, where each row's ids begin). Null ids count as none."""
    for batch in batches:
        width = pc.fill_null(pc.binary_length(batch.column("ids")), 0).to_numpy().astype(np.int64) // 4
        ends, begin = np.cumsum(width), 0
        while begin < batch.num_rows:
            done = int(ends[begin - 1]) if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, done + size, side="right")))
            rows = batch.slice(begin, stop - begin)
            ids = np.frombuffer(b"".join(x or b"" for x in rows.column("ids").to_pylist()), "<u4")
            yield rows, ids, np.concatenate([[0], ends[begin:stop] - done])
            begin = stop


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the decimal ids joined by commas, and of the text that the ids spell.

    Ids and texts stay in the task that made them; `encode` and `decode` return them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, labels = AutomatonEncoder.of(path), Labels.of(path)
        decimal = Labels.decimal(len(labels.begin) - 1)
        for rows, data, at in text_chunks(batches):
            ids, bounds = encoder.encode(data, at)
            raw, cuts = decimal.written(ids, bounds)
            spelled = [hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            decoded = [hashlib.sha256(text.encode()).hexdigest() for text in labels.texts(ids, bounds)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(bounds)), pa.array(spelled), pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return keyed(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
