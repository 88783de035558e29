"""Token ids of many texts with a public tokenizer, through the distinct pieces of a batch.

A text is cut where no token can cross: before a run of ASCII white space that follows another
character, and between an ASCII letter and ASCII punctuation. The pieces of a batch are
dictionary-encoded in Arrow, the tokenizer sees each distinct piece once (and remembers it in the
worker), and the ids of the texts are gathered from the pieces' ids in numpy. What the tokenizer's
own normaliser does away with (capitals, kinds of white space) is evened out first, so that fewer
pieces are distinct. A piece that is one plain word (`WORD`) goes to the tokenizer's model at once, spelled as its own
pre-tokenizer spells it, since normalising and splitting leave it as it is. Texts that spell a special token are handed over whole. Both public files used here split their input at these
places; `tests/llm/test_tokens.py` compares with whole-text encoding.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[33:127] = True
_MARK &= ~_LETTER
_MARK[48:58] = False
#: Plain words: a blank at most, then ASCII letters and small letters of Latin-1, which are their own lower case and NFC.
WORD = re.compile(r" ?[A-Za-z\u00DF-\u00F6\u00F8-\u00FF]+")
_WIDE = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
#: Pieces a worker remembers; beyond that it starts anew, which costs time and changes nothing.
REMEMBERED = 600_000
_WORKERS: dict[str, "Encoder"] = {}


def cuts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Offsets at which pieces begin: every text's start and every place where it may be cut."""
    blank = _BLANK[data]
    begins = np.zeros(len(data), bool)
    begins[1:] = (blank[1:] & ~blank[:-1]) | (_MARK[data[1:]] & _LETTER[data[:-1]])
    p = np.flatnonzero(begins)
    # No cut after other white space: it belongs to the run that follows.
    odd = p[data[p - 1] >= 0x80]
    if len(odd):
        a, b = data[odd - 1], data[np.maximum(odd - 2, 0)]
        c = data[np.maximum(odd - 3, 0)]
        wide = ((b == 0xC2) & ((a == 0x85) | (a == 0xA0))) | ((c == 0xE1) & (b == 0x9A) & (a == 0x80)) | ((c == 0xE3) & (b == 0x80) & (a == 0x80))
        wide |= (c == 0xE2) & (((b == 0x80) & ((a <= 0x8A) | np.isin(a, (0xA8, 0xA9, 0xAF)))) | ((b == 0x81) & (a == 0x9F)))
        begins[odd[wide]] = False
    begins[at[:-1][at[:-1] < len(data)]] = True
    return np.flatnonzero(begins)


class Encoder:
    """A tokenizer file and what this process has encoded with it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        steps = (json.loads(self.tokenizer.to_str())["normalizer"] or {}).get("normalizers", [])
        self.fold = np.arange(256, dtype=np.uint8)
        if any(x["type"] == "Lowercase" for x in steps):
            self.fold[65:91] += 32
        if any(x["type"] == "Replace" and x["pattern"].get("Regex") == "\\s+" and x["content"] == " " for x in steps):
            self.fold[9:14] = 32
        self._word_spelling()
        self.forget()

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in _WORKERS:
            _WORKERS[path] = cls(path)
        return _WORKERS[path]

    def _word_spelling(self) -> None:
        """How the pre-tokenizer hands a plain word to the model: what stands for a blank before it, and for each wide letter; None if it is not left whole."""
        normal, split = json.loads(self.tokenizer.to_str())["normalizer"], self.tokenizer.pre_tokenizer
        even = normal is None or normal["type"] == "Sequence" and all(x["type"] in ("NFC", "Lowercase") or x["type"] == "Replace" and x["pattern"].get("Regex") == "\\s+" for x in normal["normalizers"])
        spelled = [[part for part, _ in split.pre_tokenize_str(x)] if even and split else [] for x in (" aZ", "aZ", *_WIDE)]
        self.lead = None
        if all(len(x) == 1 for x in spelled) and spelled[0][0].endswith("aZ") and spelled[1] == ["aZ"]:
            self.lead, self.wide = spelled[0][0][:-2], {ord(c): x[0] for c, x in zip(_WIDE, spelled[2:])}
            self.model = self.tokenizer.model

    def _ids(self, texts: list[str]) -> list[list[int]]:
        """The ids of each piece."""
        if self.lead is None:
            return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        out: list[list[int]] = []
        other = []
        for text in texts:
            if WORD.fullmatch(text):
                word = self.lead + text[1:] if text[0] == " " else text
                out.append([x.id for x in self.model.tokenize(word if text.isascii() else word.translate(self.wide))])
            else:
                other.append(len(out))
                out.append([])
        for i, x in zip(other, self.tokenizer.encode_batch_fast([texts[i] for i in other], add_special_tokens=False)):
            out[i] = x.ids
        return out

    def forget(self) -> None:
        self.pieces = pa.array([], pa.large_binary())
        self.begin, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _learn(self, new: pa.Array) -> None:
        ids = self._ids([x.decode() for x in new.to_pylist()])
        begin = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) + self.begin[-1]
        self.pieces = pa.concat_arrays([self.pieces, new])
        self.begin = np.concatenate([self.begin, begin])
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in ids for i in x), np.uint32, int(begin[-1] - len(self.ids)) if len(begin) else 0)])

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """The place of each distinct piece among the remembered ones."""
        known = pc.index_in(distinct, value_set=self.pieces)
        if known.null_count:
            missing = pc.is_null(known)
            if len(self.pieces) + known.null_count > REMEMBERED:
                self.forget()
                self._learn(distinct)
                return np.arange(len(distinct))
            first = len(self.pieces)
            self._learn(distinct.filter(missing))
            places = known.fill_null(0).to_numpy().astype(np.int64)
            places[missing.to_numpy(zero_copy_only=False)] = np.arange(first, len(self.pieces))
            return places
        return known.to_numpy().astype(np.int64)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other (uint32), and where each text's ids begin, one more at the end."""
        folded = self.fold[data]
        raw = folded.tobytes()
        if any(s in raw for s in self.special):
            return self._encode_one_by_one(data.tobytes(), at)
        data = folded
        starts = cuts(data, at)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        offsets = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        coded = pieces.dictionary_encode()
        places = self._places(coded.dictionary)[coded.indices.to_numpy()]
        size = self.begin[places + 1] - self.begin[places]
        ends = np.cumsum(size)
        shift = np.repeat(self.begin[places] - (ends - size), size)
        ids = self.ids[shift + np.arange(int(ends[-1]))]
        bounds = np.concatenate([[0], ends])[np.searchsorted(starts, at)]
        return ids, bounds

    def _encode_one_by_one(self, raw: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        found = []
        for text in texts:
            if any(s in self.fold[np.frombuffer(text, np.uint8)].tobytes() for s in self.special):
                found.append(np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32))
            else:
                found.append(self.encode(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0])
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        return np.concatenate([*found, np.zeros(0, np.uint32)]), bounds


def with_end(ids: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the id `end` after each text."""
    return np.insert(ids, bounds[1:], np.uint32(end)), bounds + np.arange(len(bounds))
