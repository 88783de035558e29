"""Secret scans: exact base patterns, and a character convolutional network over every candidate.

Base spans come from three patterns (see `base_spans`). The method adds candidates: all runs of 16
or more characters of `CANDIDATE`; of a run that base spans cover in part, each uncovered rest, however short. Each is judged
with its context, `CONTEXT` characters on each side. The frame slides over a candidate longer than
`INSIDE` in steps of `STRIDE`, and its highest score counts.

The network: one-hot characters of a fixed frame, convolutions of width 5, maximum over places
inside the candidate and over the context apart, one hidden layer, sigmoid; trained in numpy
by Adam on labelled findings. Secrets: what a base pattern covers, and planted tokens of other
shapes (`SHAPES`) in contexts of the table. Others: candidates that no base pattern touches and that
do not look like a token (`alike`), since a secret of an unknown shape may be among those, and
planted paths, addresses and names. Documents are dealt to two folds by their text; each is scored
by the network fitted on the other fold.
Training takes every distinct frame of the table, dealt by hash into parts of about `PART_ROWS` of one fold, each with planted
findings of its own. In each of `ROUNDS` rounds every part goes on from the same weights of the other fold's network, once over its
frames, and the weights are averaged by the parts' sizes (as sums of whole numbers, so their order is without effect). Then every
part, whole, calibrates the network that judges its fold and has seen nothing of it: the scores are counted in bins of a 1/`GRAIN` of
a logit, a temperature is fitted on the counts, then the threshold is the largest lower edge of a bin, up to `EVEN`, that keeps
`RECALL` of the base findings and of the planted secrets. So each frame fits one network and calibrates the other one. An ordinary
frame of both folds calibrates both and fits neither, since both judge it; a base finding of both, which none judges, is dealt to one by hash.
Both networks begin as one fixed network, fitted on planted findings only (`fixed`), and go on with the planted ones
and what the table has, be it nothing; so no number of findings decides which method answers.

What looks like a token to `alike` teaches nothing, so the calibrated recall holds for base findings
and planted shapes; for other shapes nothing is promised. False alarms are measured on whole kinds of ordinary runs, recall on whole
shapes, that a network has not seen (`tests/llm/test_secrets.py`).

Null text counts as empty. Every row is returned with the spans of its text, repeated rows too.
Spans are in code points, end exclusive.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import importable, keyed, stored, text_array

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "network")

CONTEXT = 24
INSIDE = 48
STRIDE = 16
LEAST = 16
FRAME = CONTEXT + INSIDE + CONTEXT
PART_ROWS = 8_000
ROUNDS = 3
PLANTED = 4_000
LEAST_STEPS = 1_000
RECALL = 0.99
EVEN = 0.9
SEED = 7
FOLDS = 2
#: Bins of a logit, which is cut at LARGEST; weights are summed as whole numbers of 1 / WHOLE.
GRAIN = 256
LARGEST = 120
WHOLE = 1 << 24

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALNUM = LOWER + UPPER + DIGITS
#: Shapes of planted secrets: parts of (fixed text, alphabet, least and most characters), joined.
SHAPES = {
    "github": (("ghp_", ALNUM, 36, 36),),
    "payment": (("sk_live_", ALNUM, 24, 34),),
    "chat": (("xoxb-", DIGITS, 11, 13), ("-", DIGITS, 11, 13), ("-", ALNUM, 24, 24)),
    "cloud": (("AIza", ALNUM + "_-", 35, 35),),
    "deploy": (("glpat-", ALNUM + "_-", 20, 20),),
    "jwt": (("eyJ", ALNUM, 20, 40), (".eyJ", ALNUM, 30, 80), (".", ALNUM + "_-", 43, 43)),
    "base64": (("", ALNUM + "+/", 40, 88),),
    "mixed": (("", ALNUM, 20, 40),),
    "base36": (("", LOWER + DIGITS, 20, 40),),
    "base32": (("", UPPER + "234567", 26, 32),),
    "letters": (("", LOWER + UPPER, 24, 40),),
    "model": (("hf_", LOWER + UPPER, 30, 36),),
    "package": (("npm_", ALNUM, 36, 36),),
    "mail": (("SG.", ALNUM + "_-", 22, 22), (".", ALNUM + "_-", 43, 43)),
}
KNOWN = re.compile(r"(?:gh[oprsu]_|github_pat_|glpat-|[sprk]k_(?:live|test)_|sk-|xox[abprs]-|AIza|ya29\.|eyJ|hf_|npm_|pypi-|SG\.|AKIA|ASIA)")
RUN = re.compile(r"[A-Za-z0-9+/]{16,}")
TURN = re.compile(r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])")
LEAST_TURNS = 5
STEMS = "account archive build cache client common config content data default docs example file home image index invoice item lib local login mail main media message module network node order page path project public report request resource response search server service session source static status store system table task test update user value version view window".split()
#: Kinds of ordinary runs, as forms that `written` fills in.
FORMS = {
    "doi": ("10.####/@.####.##.###", "10.####/j.@.####.##.###", "10.####/s#####-###-####-#", "10.#####/@-####-####"),
    "isbn": ("978-#-##-######-#", "978-#-####-####-#", "979-##-#####-##-#", "ISBN=978##########", "ISSN-####-####-####"),
    "phone": ("+1-###-###-####", "+49-###-########", "001-###-###-####", "+##.###.###.####", "0##-####-####-##"),
    "moment": ("20##-##-##T##-##-##", "20##-##-##-##-##-##", "20######T######Z", "20##-##-##_##.##.##", "19##-##-##/20##-##-##", "##-##-20##-##.##"),
    "photo": ("IMG_20######_######.jpg", "DSC_####_20######.JPG", "Screenshot_20######-######.png", "VID-20######-WA####.mp4", "scan_####_####_##.tiff"),
    "version": ("@-#.##.#-beta.##", "v#.#.##-rc#.20######", "@-@-##.#.###.tar.gz", "#.##.#####.####", "@_#.#.#-#ubuntu#.##", "@-##.##.#-x86_64.rpm"),
    "class": ("com.@.@.^^^", "org.@.^^Factory", "^^^Exception", "^^^^", "@.@.^^.@^", "System.^.^^"),
    "net": ("192.168.###.###/##", "##.###.##.###.in-addr.arpa", "10.#.##.###-10.#.##.###", "ec2-##-##-###-##.@"),
    "order": ("INV-20##-######", "PO-########-##", "@-########-###", "RMA########-###", "%%-####-%%-####", "%###-####-####-##"),
    "place": ("##.######/-##.######", "-##.####.##.####.#", "N##.####/E###.####", "####/####/####.####"),
    "sums": ("#.###.###.###.##", "################", "####.##-####.##/####", "#.##e-##/#.##e+##", "##########-##########"),
    "path": ("/@/@/@.py", "/@/@/@#/@-@/@.py", "/@/@/@-@/@_@.@", "./@/@/@.@#", "/@/@/@/@/", "@/@/@_@.json", "../@/@-@.html", "/@/@/@@#/@.txt", "/@/##/@/####.log"),
    "camel": ("@^^^", "@^^^^^", "^^^@", "get^^By^", "@^#^^"),
    "url": ("www.@@.com/@/@", "@.@#.example.com/@/@/@", "@.example.org/@/####/##/@", "example.com/@/####-@-@-@"),
    "joined": ("@_@_@_@", "@-@-@-@", "@.@.@.@", "@_@_##_@", "%%%_%%%%_%%%%%%", "@=@=@/@"),
    "dated": ("@/20##-##-##/@_###", "@-20##-##-##.csv", "20##/##/##/@-@-@", "@_20######_v#.xlsx"),
    "part": ("@-##%%-####-##", "%%##-####-%", "SN-##########", "Model-%%-####/##", "@.###.###.###"),
}
#: Frames judged at once.
JUDGED = 4_096


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base findings by start, then kind.

    `[0-9a-f]{16,}` and dropping short runs of `[0-9a-f]+` find the same; an assignment is matched
    in full first and dropped afterwards, since its match may hide a later one.
    """
    found = []
    lower = text.encode().lower()
    if any(name in lower for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text)]


def pieces(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kind) of every candidate, cut where base spans begin and end. Kind: 1 covered, -1 a rest, 0 free as a whole."""
    out = []
    for start, end in candidates(text):
        at = start
        for s, _, e in base:
            s, e = max(s, at), min(e, end)
            if s < e:
                out += [(at, s, -1), (s, e, 1)]
                at = e
        out.append((at, end, 0 if at == start else -1))
    return [x for x in out if x[1] > x[0]]


def places(start: int, end: int) -> list[int]:
    """Where the frame's inside begins as it slides over a candidate; the last one ends with it."""
    last = max(start, end - INSIDE)
    return [*range(start, last, STRIDE), last]


def codes(text: str, start: int, end: int, at: int | None = None) -> np.ndarray:
    """FRAME character classes: context before, INSIDE characters of the candidate from `at` (padded), context after; 0 is padding."""
    at = start if at is None else at
    frame = np.zeros(FRAME, np.uint8)
    parts = ((text[max(0, start - CONTEXT) : start].rjust(CONTEXT, "\0"), 0), (text[at : min(end, at + INSIDE)], CONTEXT), (text[end : end + CONTEXT], CONTEXT + INSIDE))
    for part, at in parts:
        raw = np.frombuffer(part.encode("utf-32-le"), np.uint32)
        frame[at : at + len(raw)] = np.minimum(raw, 127)
    return frame


def alike(candidate: str) -> bool:
    """Whether an unmatched candidate may be a token: a known beginning, or a run that turns often between letters of both cases and digits."""
    return bool(KNOWN.search(candidate)) or any(
        any(c.isdigit() for c in run) and len(TURN.findall(run)) >= LEAST_TURNS or len(run) >= 20 and run.isupper() and any(c.isdigit() for c in run)
        for run in RUN.findall(candidate)
    )


def token(rng: np.random.Generator, shape: str) -> str:
    return "".join(lead + "".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(least, most + 1))) for lead, letters, least, most in SHAPES[shape])


def written(rng: np.random.Generator, form: str) -> str:
    """A form with its signs filled in: # digit, * small and % capital letter, @ a word, ^ a word with a capital."""
    def one(sign: str) -> str:
        if sign in "@^":
            word = str(rng.choice(STEMS)) if rng.random() < 0.5 else spoken(rng, int(rng.integers(2, 10)))
            return word.capitalize() if sign == "^" else word
        letters = {"#": DIGITS, "*": LOWER, "%": UPPER}.get(sign, sign)
        return letters[rng.integers(len(letters))]

    return "".join(one(c) for c in form)


def spoken(rng: np.random.Generator, n: int) -> str:
    """n letters that make a word one can say."""
    sounds = ("bcdfghjklmnpqrstvwxz", "aeiou", "lmnrst") if rng.random() < 0.6 else ("aeiouy", "bcdfgklmnprst")
    return "".join(sounds[i % len(sounds)][rng.integers(len(sounds[i % len(sounds)]))] for i in range(n))


def invented(rng: np.random.Generator) -> str:
    """A long word that can be spoken, or a run of small letters, sometimes with a dot or number behind."""
    sounds = ["bcdfghklmnprst", "aeiouy", "rlnsth"] if rng.random() < 0.5 else [LOWER]
    parts = [sounds[i] for i in rng.integers(0, len(sounds), rng.integers(LEAST, 32))]
    text = "".join(part[int(u * len(part))] for part, u in zip(parts, rng.random(len(parts)))) + str(rng.choice(["", "", ".", f".{rng.integers(100)}", f"{rng.integers(100)}"]))
    return str(rng.choice([text, text, text.capitalize(), text.upper()]))


def ordinary(rng: np.random.Generator, forms: Sequence[str] = tuple(FORMS)) -> str:
    """An ordinary run of at least LEAST characters: of one of the kinds of `FORMS`, or an invented word; or a short rest of one."""
    if rng.random() < 0.3:
        text = invented(rng)
    else:
        text = written(rng, str(rng.choice(FORMS[str(rng.choice(list(forms)))])))
    text = text.upper() if rng.random() < 0.05 else text
    if rng.random() < 0.08:
        return text[: rng.integers(1, LEAST)]
    while len(text) < LEAST:
        text += str(rng.choice(["_", "-", ".", "/"])) + str(rng.choice(STEMS))
    return text


LEADS = ("", "", "", "export KEY=", "Authorization: Bearer ", "key: ", "id ", "see ", '"', "(", "use ", "https://")


def planted(rng: np.random.Generator, shapes: Sequence[str], forms: Sequence[str], contexts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """About n frames of secrets of the shapes and as many of ordinary runs, in the contexts of given frames or, without any, of words."""
    frames, labels = [], []
    for i in range(n):
        for label, run in ((1, token(rng, shapes[i % len(shapes)])), (0, ordinary(rng, forms))):
            lead = str(rng.choice(LEADS)).strip("=") if label == 0 else str(rng.choice(LEADS))
            before, after = ("".join(f" {w}" for w in rng.choice(STEMS, 4)) + " " for _ in range(2))
            text = before + lead.replace("=", " ") + run + after
            start = text.index(run, len(before))
            at = places(start, start + len(run))
            frame = codes(text, start, start + len(run), int(rng.choice(at)))
            if len(contexts) and rng.random() < 0.7:
                like = contexts[rng.integers(len(contexts))]
                frame[:CONTEXT], frame[CONTEXT + INSIDE :] = like[:CONTEXT], like[CONTEXT + INSIDE :]
            frames.append(frame)
            labels.append(label)
    return np.array(frames, np.uint8).reshape(-1, FRAME), np.array(labels, np.int64)


WEIGHTS = ("embed", "conv", "bias", "hidden", "hidden_bias", "out", "out_bias")


@dataclass
class Network:
    """Weights as arrays; `filters` convolutions over an embedding of `width` for each character."""

    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 1.0
    span: int = 5

    @classmethod
    def new(cls, rng: np.random.Generator, width: int = 12, filters: int = 32, hidden: int = 24) -> "Network":
        draw = lambda *shape: (rng.standard_normal(shape) * np.sqrt(2 / shape[0])).astype(np.float32)
        embed = (rng.standard_normal((128, width)) * 0.3).astype(np.float32)
        embed[0] = 0
        zeros = lambda n: np.zeros(n, np.float32)
        return cls(embed, draw(5 * width, filters), zeros(filters), draw(2 * filters, hidden), zeros(hidden), draw(hidden, 1)[:, 0], zeros(1))

    def flat(self) -> np.ndarray:
        """All weights one after the other."""
        return np.concatenate([getattr(self, name).ravel() for name in WEIGHTS])

    def filled(self, values: np.ndarray) -> "Network":
        """The same network with other weights, in the order of `flat`."""
        ends = np.cumsum([getattr(self, name).size for name in WEIGHTS])
        parts = np.split(values.astype(np.float32), ends[:-1])
        return replace(self, **{name: part.reshape(getattr(self, name).shape) for name, part in zip(WEIGHTS, parts)})

    def _forward(self, frames: np.ndarray):
        e = self.embed[frames]
        n = FRAME - self.span + 1
        x = np.concatenate([e[:, k : k + n] for k in range(self.span)], axis=2)
        z = x @ self.conv + self.bias
        inside = slice(CONTEXT, CONTEXT + INSIDE - self.span + 1)
        a = z[:, inside].argmax(axis=1) + CONTEXT
        masked = z.copy()
        masked[:, inside] = -np.inf
        b = masked.argmax(axis=1)
        peak = np.concatenate([np.take_along_axis(z, i[:, None], 1)[:, 0] for i in (a, b)], axis=1)
        p = np.maximum(peak, 0)
        h = np.maximum(p @ self.hidden + self.hidden_bias, 0)
        return x, (a, b), peak, p, h, h @ self.out + self.out_bias[0]

    def logits(self, frames: np.ndarray) -> np.ndarray:
        parts = [self._forward(frames[i : i + 256])[-1] for i in range(0, len(frames), 256)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def probability(self, frames: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(frames) / self.temperature, -30, 30)))

    def gradients(self, frames: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        x, at, peak, p, h, logit = self._forward(frames)
        d = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) / len(labels)).astype(np.float32)
        dh = np.outer(d, self.out) * (h > 0)
        dp = (dh @ self.hidden.T) * (peak > 0)
        filters = self.conv.shape[1]
        dconv, dembed, rows = np.zeros_like(self.conv), np.zeros_like(self.embed), np.arange(len(d))
        width = self.embed.shape[1]
        for part, places in enumerate(at):
            g = dp[:, part * filters : (part + 1) * filters]
            dconv += np.einsum("bf,bfw->wf", g, x[rows[:, None], places], optimize=True)
            back = g[:, :, None] * self.conv.T
            for k in range(self.span):
                seen = frames[rows[:, None], places + k].ravel()
                for w in range(width):
                    dembed[:, w] += np.bincount(seen, back[:, :, k * width + w].ravel(), len(dembed))
        dembed[0] = 0
        return {"embed": dembed, "conv": dconv, "bias": dp[:, :filters].sum(0) + dp[:, filters:].sum(0), "hidden": p.T @ dh, "hidden_bias": dh.sum(0), "out": h.T @ d, "out_bias": d.sum(keepdims=True)}


def descend(net: Network, frames: np.ndarray, labels: np.ndarray, epochs: int, rng: np.random.Generator, batch: int = 64, rate: float = 3e-3) -> Network:
    """The network after `epochs` of Adam over the frames."""
    net = replace(net)
    state: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    step = 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(frames)), max(1, len(frames) // batch)):
            step += 1
            for name, g in net.gradients(frames[at], labels[at].astype(np.float32)).items():
                m, v = state.get(name, (0.0, 0.0))
                m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                state[name] = (m, v)
                setattr(net, name, (getattr(net, name) - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32))
    return net


def bins(logits: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(logits.astype(np.float64), -LARGEST, LARGEST) * GRAIN).astype(np.int64)


def calibrated(net: Network, kinds: np.ndarray, truth: np.ndarray, places: np.ndarray, counts: np.ndarray) -> Network:
    """The network with a temperature and a threshold from how many held frames of each kind and label have their logit in each bin; `RECALL` is kept for each kind."""
    logit = (places + 0.5) / GRAIN

    def loss(t: float) -> float:
        return float(np.sum(counts * (np.logaddexp(0, logit / t) - truth * logit / t)))

    temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    edges = []
    for kind in np.unique(kinds[truth > 0]):
        own = np.flatnonzero((truth > 0) & (kinds == kind))
        own = own[np.argsort(places[own])]
        upto = np.cumsum(counts[own])
        edges.append(places[own][np.searchsorted(upto, int((1 - RECALL) * upto[-1]), side="right")] / GRAIN)
    threshold = min([EVEN, *(float(1 / (1 + np.exp(-np.clip(e / temperature, -30, 30)))) for e in edges)]) if edges else 1.0
    return replace(net, temperature=temperature, threshold=threshold)


@dataclass
class Folds:
    """A network for each fold of the documents, fitted on the other ones."""

    nets: tuple[Network, ...]

    def of(self, text: str) -> Network:
        return self.nets[fold(text)]

    @property
    def threshold(self) -> float:
        return float(np.mean([net.threshold for net in self.nets]))

    def probability(self, frames: np.ndarray) -> np.ndarray:
        """For frames outside the table: the mean of the networks."""
        return np.mean([net.probability(frames) for net in self.nets], axis=0)


def fold(text: str) -> int:
    return zlib.crc32(text.encode()) % FOLDS


@lru_cache(maxsize=2)
def fixed(shapes: Sequence[str] = tuple(SHAPES), forms: Sequence[str] = tuple(FORMS)) -> Network:
    """The network with which all others begin; fitted on planted findings only."""
    frames, labels = planted(np.random.default_rng(SEED), shapes, forms, np.zeros((0, FRAME), np.uint8), PLANTED)
    held, rng = calibrates(len(labels)), np.random.default_rng(SEED)
    net = Network.new(rng)
    steps = max(1, int((~held).sum()) // 64)
    net = descend(net, frames[~held], labels[~held], max(6, -(-LEAST_STEPS // steps)), rng)
    return calibrated(net, np.ones(int(held.sum()), np.int64), labels[held], bins(net.logits(frames[held])), np.ones(int(held.sum()), np.int64))


def calibrates(n: int) -> np.ndarray:
    """Which of n planted frames only calibrate the fixed network: every fifth pair."""
    return np.arange(n) // 2 % 5 == 0


def _findings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        frames, labels, folds = [], [], []
        for text in text_array(batch.column("text")).to_pylist():
            base = base_spans(text)
            values = [(m.start(2), m.end(2), 1) for m in (ASSIGN.match(text, s) for s, kind, _ in base if kind == 0) if m]
            part = fold(text)
            for start, end, kind in pieces(text, base) + values:
                # What is left of a candidate that holds a secret, and what looks like one, is judged, but teaches nothing.
                for at in places(start, end) if kind > 0 or kind == 0 and not alike(text[start:end]) else ():
                    folds.append(part)
                    labels.append(kind)
                    frames.append(codes(text, start, end, at).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(folds, pa.int32()), pa.array(frames, pa.binary())], ["label", "fold", "frame"])


def _stacked(frames) -> np.ndarray:
    return np.frombuffer(b"".join(frames.to_pylist()), np.uint8).reshape(-1, FRAME)


def _array(column) -> np.ndarray:
    return column.to_numpy()


PART_SCHEMA = "net int, part long, kind int, label int, held int, frame binary"


def _with_planted(shapes: Sequence[str], forms: Sequence[str]):
    def run(table: pa.Table) -> pa.Table:
        net, part = table.column("net")[0].as_py(), table.column("part")[0].as_py()
        table = table.filter(pc.is_valid(table.column("frame"))).sort_by("frame")
        found, labels = _stacked(table.column("frame")), _array(table.column("label")).astype(np.int64)
        held = _array(table.column("held")).astype(np.int32)
        more, truth = planted(np.random.default_rng([SEED + 1 + net, part]), shapes, forms, found[(labels == 0) & (held == 1)], PLANTED)
        n, m = len(labels), len(truth)
        columns = [
            np.full(n + m, net, np.int32), np.full(n + m, part, np.int64), np.repeat([0, 1], [n, m]).astype(np.int32), np.concatenate([labels, truth]).astype(np.int32),
            np.concatenate([held, np.ones(m, np.int32)]),
        ]
        frames = pa.array([f.tobytes() for f in np.concatenate([found, more])], pa.binary())
        return pa.Table.from_arrays([*map(pa.array, columns), frames], [c.split()[0] for c in PART_SCHEMA.split(", ")])

    return run


def parts(docs: DataFrame, shapes: Sequence[str] = tuple(SHAPES), forms: Sequence[str] = tuple(FORMS), rows: int = PART_ROWS) -> DataFrame:
    """(net, part, kind, label, held, frame): every distinct labelled frame of the documents by the network that it calibrates (kind 0), and each part's planted ones (kind 1).

    `held` tells how many networks judge documents with the frame; only if it is one, the others are fitted on it (`fitted`).
    A part has about `rows` frames of the table; each network has as many parts, one at least.
    """
    seen = keyed(docs).select("text").mapInArrow(_findings, "label int, fold int, frame binary").groupBy("frame").agg(
        F.max("label").alias("label"), F.array_sort(F.collect_set("fold")).alias("folds"))
    one = F.expr("array(element_at(folds, CAST(pmod(xxhash64(frame), size(folds)) AS int) + 1))")
    seen = seen.withColumn("folds", F.when(F.col("label") == 1, one).otherwise(F.col("folds")))
    found = stored(seen.select("label", "frame", F.size("folds").alias("held"), F.explode("folds").alias("net")), "findings")
    n = max(1, -(-max((r["count"] for r in found.groupBy("net").count().collect()), default=0) // rows))
    own = found.select("net", F.pmod(F.xxhash64("frame", F.lit(SEED)), F.lit(n)).cast("long").alias("part"), "label", "held", "frame")
    # A row without a frame stands for each part, so that one without findings is there as well.
    marks = docs.sparkSession.range(FOLDS * n).selectExpr(f"CAST(id % {FOLDS} AS int) AS net", f"id div {FOLDS} AS part", "CAST(NULL AS int) AS label", "1 AS held", "CAST(NULL AS binary) AS frame")
    return stored(grouped(own.unionByName(marks), n).applyInArrow(_with_planted(tuple(shapes), tuple(forms)), PART_SCHEMA), "parts")


def fitted(table: DataFrame) -> DataFrame:
    """(net, part, kind, label, frame): what each network is fitted on, the parts of the folds that it does not judge."""
    others = F.explode(F.expr(f"filter(sequence(0, {FOLDS - 1}), k -> k <> net)"))
    return table.filter("held = 1").select(others.alias("net"), "part", "kind", "label", "frame")


def grouped(rows: DataFrame, n: int):
    """Rows by network and part, over as many tasks as there are parts, or shuffle partitions if those are fewer."""
    tasks = min(FOLDS * n, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(max(1, tasks), "net", "part").groupBy("net", "part")


def _gone_on(nets: tuple[Network, ...], turn: int):
    """One part's weights after a pass over it, times its frames."""
    def run(table: pa.Table) -> pa.Table:
        net, part = table.column("net")[0].as_py(), table.column("part")[0].as_py()
        table = table.sort_by([("kind", "ascending"), ("frame", "ascending"), ("label", "ascending")])
        frames, labels = _stacked(table.column("frame")), _array(table.column("label"))
        weights = descend(nets[net], frames, labels, 1, np.random.default_rng([SEED, turn, net, part])).flat()
        total = np.rint(weights.astype(np.float64) * WHOLE).astype(np.int64) * len(labels)
        columns = [np.full(len(total), net, np.int32), np.arange(len(total), dtype=np.int32), total, np.full(len(total), len(labels), np.int64)]
        return pa.Table.from_arrays([*map(pa.array, columns)], ["net", "place", "total", "n"])

    return run


def _binned(nets: tuple[Network, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frames, own = _stacked(batch.column("frame")), _array(batch.column("net"))
            places = np.zeros(len(own), np.int64)
            for k, net in enumerate(nets):
                places[own == k] = bins(net.logits(frames[own == k]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("net", "kind", "label")), pa.array(places)], ["net", "kind", "label", "place"])

    return run


def train(docs: DataFrame, shapes: Sequence[str] = tuple(SHAPES), forms: Sequence[str] = tuple(FORMS), rows: int = PART_ROWS) -> Folds:
    """Fit on planted findings and on all distinct labelled ones of all documents; the driver sees sums of weights and counts of scores."""
    table = parts(docs, shapes, forms, rows)
    n = table.agg(F.max("part")).first()[0] + 1
    nets = (fixed(tuple(shapes), tuple(forms)),) * FOLDS
    for turn in range(ROUNDS):
        gone_on = grouped(fitted(table), n).applyInArrow(_gone_on(nets, turn), "net int, place int, total long, n long")
        sums = gone_on.groupBy("net", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).orderBy("net", "place").collect()
        nets = tuple(net.filled(np.array([r["total"] / r["n"] / WHOLE for r in sums if r["net"] == k])) for k, net in enumerate(nets))
    counts = table.select("net", "kind", "label", "frame").mapInArrow(_binned(nets), "net int, kind int, label int, place long")
    counts = counts.groupBy("net", "kind", "label", "place").count().collect()
    own = [np.array([r[1:] for r in counts if r["net"] == k], np.int64).T for k in range(FOLDS)]
    return Folds(tuple(calibrated(net, *x) for net, x in zip(nets, own)))


def all_spans(texts: list[str], net: Folds | None) -> list[list[tuple[int, int, int]]]:
    """Base and added spans of each text as (start, kind, end), sorted."""
    out = [base_spans(t) for t in texts]
    if net is None:
        return out
    added: list[set[tuple[int, int, int]]] = [set() for _ in texts]
    waiting: dict[int, tuple[Network, list, list]] = {}

    def judge(own: Network, frames: list, where: list) -> None:
        if frames:
            for (i, start, end), p in zip(where, own.probability(np.stack(frames)).tolist()):
                if p >= own.threshold:
                    added[i].add((start, 3, end))
        frames.clear()
        where.clear()

    for i, text in enumerate(texts):
        own = net.of(text) if isinstance(net, Folds) else net
        own, frames, where = waiting.setdefault(id(own), (own, [], []))
        for start, end, kind in pieces(text, out[i]):
            for at in places(start, end) if kind < 1 else ():
                frames.append(codes(text, start, end, at))
                where.append((i, start, end))
                if len(frames) == JUDGED:
                    judge(own, frames, where)
    for group in waiting.values():
        judge(*group)
    return [sorted([*s, *a]) for s, a in zip(out, added)]


SPAN_SCHEMA = "array<struct<start: long, kind: string, end: long>>"


def scan(docs: DataFrame, net: Folds) -> DataFrame:
    """(doc_id, _id, _hash, spans): one row for each row of `docs`; the weights (under 100 kB) go along with the code."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
        for batch in batches:
            found = all_spans(text_array(batch.column("text")).to_pylist(), net)
            rows = [[{"start": s, "kind": KINDS[k], "end": e} for s, k, e in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "_id", "_hash")), pa.array(rows, kind)], ["doc_id", "_id", "_hash", "spans"])

    return keyed(docs).mapInArrow(run, f"doc_id long, _id long, _hash long, spans {SPAN_SCHEMA}")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of `scan`; the spans come sorted by start, then kind."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"] != "network")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, net: Folds, mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every span of `text` replaced by `mark` (overlapping spans together); n_chars follows where it exists."""
    schema, columns = docs.schema, docs.columns
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(columns.index("text")).to_pylist()
            done = []
            for text, spans in zip(texts, all_spans([t or "" for t in texts], net)):
                parts, at = [], 0
                for start, _, end in spans:
                    if start >= at:
                        parts += [text[at:start], mark]
                    at = max(at, end)
                done.append("".join(parts) + text[at:] if spans else text)
            new = {"text": pa.array(done, batch.schema.field("text").type)}
            if "n_chars" in columns:
                old = batch.column(columns.index("n_chars")).to_pylist()
                new["n_chars"] = pa.array([n if a == b else len(b) for n, a, b in zip(old, texts, done)], batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(i)) for i, c in enumerate(columns)], columns)

    return docs.mapInArrow(run, schema)
