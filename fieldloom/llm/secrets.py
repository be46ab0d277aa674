"""Secret scan: fixed patterns, and a character convolutional network over candidates.

The patterns give the base findings. Every other token of six characters and more,
anywhere in a text, is a candidate; a small network in numpy reads it with its
surroundings and adds those whose calibrated probability passes a threshold that keeps a stated recall.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_bytes

# The patterns of the base findings and the least length of what counts.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# The same on UTF-8 bytes: all that they match is ASCII.
_PATTERNS = {
    "assign": (re.compile(ASSIGN.pattern.encode(), re.IGNORECASE), 2),
    "access": (re.compile(ACCESS.pattern.encode()), 0),
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "learned")

#: Candidates: runs of token characters, dots inside included, of at least this length.
TOKEN = 6
#: The network reads so many characters before a token, of it, and behind it.
BEFORE, INSIDE, BEHIND = 20, 40, 8
WIDTH = BEFORE + INSIDE + BEHIND
#: Texts whose candidates and contexts the training set is made from, at most, and how
#: much of a text's bytes one of them may have.
SAMPLE_ROWS, SAMPLE_TEXT_BYTES = 1500, 1 << 16
#: Share of held-out findings that the threshold has to keep, of each sort of findings
#: that has this many.
RECALL, SORT_ROWS = 0.95, 40
EMBED, SPAN, FILTERS = 8, 5, 24
EPOCHS, BATCH, RATE = 8, 64, 0.01
#: Own plain tokens of the texts that the network learns to reject, at most.
PLAIN = 6000

# Texts are scanned in slices of about so many bytes, as each byte takes many times that.
SLICE_BYTES = 1 << 20
# Windows that the network reads at a time.
_BLOCK = 256
_ALPHABET = 98  # printable ASCII, other, none
_CODE = np.full(256, 96, np.uint8)
_CODE[32:127] = np.arange(95)
_NONE = 97
_HEX = np.zeros(256, bool)
_HEX[[*range(0x30, 0x3A), *range(0x61, 0x67)]] = True
_TOKEN = np.zeros(256, bool)
_TOKEN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True
_DOT = ord(".")
# Words and numbers, joined or not, words with a short number behind: what is no secret
# unless it stands behind a name.
_PART = r"(?:[A-Za-z]?[a-z]*[0-9]{0,3}|[A-Z]+|[0-9]+)"
_PLAIN = re.compile(rf"{_PART}(?:[-+=/_.]+{_PART})*", re.ASCII)
_NAMED = re.compile(r"(key|auth|bearer|credential|pass|pwd|secret|token)|-k\s", re.IGNORECASE)


def _runs(mask: np.ndarray, offsets: np.ndarray, least: int):
    """Begin and end of all runs of True of at least ``least`` that lie in one text."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(mask))]
    first[edges] = mask[edges]
    last[edges - 1] = mask[edges - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    long_ = end - begin >= least
    return begin[long_], end[long_]


@dataclass
class Found:
    """Base spans per text in code points, and candidates in bytes and code points."""

    base: list[list[tuple[int, int, str]]]
    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray
    start: np.ndarray  # of the candidates, in code points
    raw: np.ndarray
    offsets: np.ndarray


def _tokens(raw: np.ndarray) -> np.ndarray:
    """Where token characters are; a dot is one between two others."""
    inside = _TOKEN[raw]
    if len(raw) > 2:
        dot = (raw[1:-1] == _DOT) & inside[:-2] & inside[2:]
        inside[1:-1] |= dot
    return inside


def find(column: pa.Array, free_only: bool = True) -> Found:
    """Base findings and candidates of all texts; null is empty.

    By default a token is a candidate if, outside the base findings, something of the
    length of a candidate is left of it; it then is one as a whole.
    """
    column = column.cast(pa.large_string()).fill_null("")
    raw, offsets = text_bytes(column)
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    base: list[list[tuple[int, int, str]]] = [[] for _ in range(len(column))]

    def point(where, text):
        return lead[where] - lead[offsets[text]]

    begin, end = _runs(_HEX[raw], offsets, LEAST["hex"])
    text = np.searchsorted(offsets, begin, "right") - 1
    for t, a, b in zip(text, point(begin, text), point(end, text)):
        base[t].append((int(a), int(b), "hex"))
    covered = list(zip(begin, end))
    marks = {
        "assign": pc.match_substring_regex(column, r"(passw|secret|token|api_?key)", ignore_case=True),
        "access": pc.match_substring(column, "AKIA"),
    }
    for kind, maybe in marks.items():
        pattern, group = _PATTERNS[kind]
        for t in np.flatnonzero(maybe.to_numpy(zero_copy_only=False)):
            low = offsets[t]
            for m in pattern.finditer(raw[low : offsets[t + 1]].tobytes()):
                if m.end(group) - m.start(group) >= LEAST[kind]:
                    a, b = low + m.start(), low + m.end()
                    base[t].append((int(point(a, t)), int(point(b, t)), kind))
                    covered.append((a, b))
    inside = _tokens(raw)
    begin, end = _runs(inside, offsets, TOKEN)
    if free_only and covered:
        for a, b in covered:
            inside[a:b] = False
        left, _ = _runs(inside, offsets, TOKEN)
        keep = np.unique(np.searchsorted(begin, left, "right") - 1)
        begin, end = begin[keep], end[keep]
    text = np.searchsorted(offsets, begin, "right") - 1
    return Found(base, begin, end, text, point(begin, text), raw, offsets)


def windows(raw, offsets, text, begin, end) -> np.ndarray:
    """Character codes of each token with its surroundings inside its text; of a token
    longer than the window its first and last characters."""
    text, begin, end = (np.asarray(x, np.int64) for x in (text, begin, end))
    offsets = np.asarray(offsets)
    if not len(begin):
        return np.full((0, WIDTH), _NONE, np.uint8)
    # The stretch of bytes that the tokens lie in, with room for windows over its ends.
    low, high = int(begin.min()) - BEFORE, int(end.max()) + max(INSIDE, BEHIND)
    codes = np.full(high - low, _NONE, np.uint8)
    codes[max(0, -low) : min(high, len(raw)) - low] = _CODE[raw[max(0, low) : high]]
    shift = BEFORE - int(begin.min())
    view = np.lib.stride_tricks.sliding_window_view
    out = np.empty((len(begin), WIDTH), np.uint8)
    left, middle, right = out[:, :BEFORE], out[:, BEFORE : BEFORE + INSIDE], out[:, BEFORE + INSIDE :]
    left[:] = view(codes, BEFORE)[begin + shift - BEFORE]
    middle[:] = view(codes, INSIDE)[begin + shift]
    right[:] = view(codes, BEHIND)[end + shift]
    long_ = np.flatnonzero(end - begin > INSIDE)
    half = INSIDE // 2
    middle[long_, half:] = view(codes, INSIDE - half)[end[long_] + shift - (INSIDE - half)]
    room = (begin - offsets[text])[:, None]
    left[np.arange(BEFORE, 0, -1) > room] = _NONE
    middle[np.arange(INSIDE) >= (end - begin)[:, None]] = _NONE
    right[np.arange(BEHIND) >= (offsets[text + 1] - end)[:, None]] = _NONE
    return out


def missed(x: np.ndarray) -> np.ndarray:
    """Which windows stand for findings that are no candidates."""
    return (x == _NONE).all(1)


class CharNet:
    """Embedding, one convolution, the maximum over each part of the window, one output."""

    PARTS = ((0, BEFORE), (BEFORE, BEFORE + INSIDE), (BEFORE + INSIDE, WIDTH))

    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        normal = lambda *s: draw.normal(0, 0.3, s).astype(np.float32)
        self.p = {
            "embed": normal(_ALPHABET, EMBED),
            "conv": normal(SPAN * EMBED, FILTERS),
            "conv_bias": np.zeros(FILTERS, np.float32),
            "out": normal(2 * len(self.PARTS) * FILTERS),
            "out_bias": np.zeros(1, np.float32),
        }
        self.slope, self.shift, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, x):
        p = self.p
        pad = np.pad(x, ((0, 0), (SPAN // 2, SPAN // 2)), constant_values=_NONE)
        cols = np.stack([pad[:, k : k + WIDTH] for k in range(SPAN)], 2)  # n, width, span
        e = p["embed"][cols].reshape(len(x), WIDTH, SPAN * EMBED)
        h = np.maximum(e @ p["conv"] + p["conv_bias"], 0)
        tops = np.stack([a + h[:, a:b].argmax(1) for a, b in self.PARTS], 1)  # n, parts, filters
        best = np.take_along_axis(h, tops, 1)
        mean = np.stack([h[:, a:b].mean(1) for a, b in self.PARTS], 1)
        z = np.concatenate([best.reshape(len(x), -1), mean.reshape(len(x), -1)], 1)
        return cols, e, h, tops, z, z @ p["out"] + p["out_bias"]

    def logits(self, x: np.ndarray) -> np.ndarray:
        tables = self._tables()
        parts = [self._logits(x[i : i + _BLOCK], tables) for i in range(0, len(x), _BLOCK)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def _tables(self) -> list[np.ndarray]:
        """What two characters side by side (the last: one) add at each place of the span."""
        one = [self.p["embed"] @ self.p["conv"][k * EMBED : (k + 1) * EMBED] for k in range(SPAN)]
        two = [(one[k][:, None] + one[k + 1][None]).reshape(-1, FILTERS) for k in range(0, SPAN - 1, 2)]
        return [*two, one[-1] + self.p["conv_bias"]]

    def _logits(self, x: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """As the last of ``_forward``, by tables in place of products."""
        p = self.p
        # Places first: then maxima and sums over places run through whole rows of memory.
        pad = np.full((WIDTH + SPAN - 1, len(x)), _NONE, np.intp)
        pad[SPAN // 2 : SPAN // 2 + WIDTH] = x.T
        h = np.take(tables[-1], pad[SPAN - 1 :], axis=0)
        both = pad[:-1] * _ALPHABET + pad[1:]
        for k, table in enumerate(tables[:-1]):
            h += np.take(table, both[2 * k : 2 * k + WIDTH], axis=0)
        np.maximum(h, 0, out=h)
        best = np.concatenate([h[a:b].max(0) for a, b in self.PARTS], 1)
        mean = np.concatenate([h[a:b].mean(0) for a, b in self.PARTS], 1)
        return np.concatenate([best, mean], 1) @ p["out"] + p["out_bias"]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(x) + self.shift, -40, 40)))

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 9) -> "CharNet":
        seen = ~missed(x)
        x, y = x[seen], y[seen]
        draw = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        step = 0
        for epoch in range(EPOCHS):
            for at in np.array_split(draw.permutation(len(x)), max(1, len(x) // BATCH)):
                cols, e, h, tops, z, logit = self._forward(x[at])
                n = len(at)
                d = ((1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y[at]) / n).astype(np.float32)
                dz = d[:, None] * self.p["out"]
                half = dz.shape[1] // 2
                best = dz[:, :half].reshape(n, len(self.PARTS), FILTERS)
                mean = dz[:, half:].reshape(n, len(self.PARTS), FILTERS)
                dh = np.zeros_like(h)
                rows, filters = np.arange(n)[:, None, None], np.arange(FILTERS)[None, None, :]
                np.add.at(dh, (rows, tops, filters), best)
                for k, (a, b) in enumerate(self.PARTS):
                    dh[:, a:b] += mean[:, k, None, :] / (b - a)
                dh *= h > 0
                flat = dh.reshape(-1, FILTERS)
                de = (flat @ self.p["conv"].T).reshape(-1, EMBED)
                embed = np.zeros_like(self.p["embed"])
                np.add.at(embed, cols.reshape(-1), de)
                gradient = {
                    "embed": embed,
                    "conv": e.reshape(-1, SPAN * EMBED).T @ flat,
                    "conv_bias": flat.sum(0),
                    "out": z.T @ d,
                    "out_bias": np.array([d.sum()], np.float32),
                }
                step += 1
                rate = RATE * (1 - epoch / EPOCHS)
                for k, g in gradient.items():  # Adam
                    g = g + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (
                        np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8
                    )
        return self

    def calibrate(
        self, x: np.ndarray, y: np.ndarray, recall: float = RECALL, sorts: np.ndarray | None = None
    ) -> "CharNet":
        """Fit slope and shift of the logits on held-out findings (Platt), and take the
        highest threshold that keeps ``recall`` of them; those that are no candidates are
        lost at any threshold. With ``sorts``, a number for each row, that share of each
        sort is kept, of those with ``SORT_ROWS`` findings or more."""
        sorts = np.zeros(len(x), np.int64) if sorts is None else sorts
        seen = ~missed(x)
        lost = np.bincount(sorts[~seen & (y == 1)], minlength=int(sorts.max(initial=0)) + 1)
        x, y, sorts = x[seen], y[seen], sorts[seen]
        logit = self.logits(x).astype(float)
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton's method, slightly damped by a prior on both
            q = 1 / (1 + np.exp(-np.clip(a * logit + b, -40, 40)))
            w = q * (1 - q)
            g = np.array([((q - y) * logit).sum() + 1e-2 * (a - 1), (q - y).sum() + 1e-2 * b])
            hess = np.array(
                [[(w * logit**2).sum() + 1e-2, (w * logit).sum()], [(w * logit).sum(), w.sum() + 1e-2]]
            )
            change = np.linalg.solve(hess, g)
            change *= min(1.0, 1.0 / max(1e-12, np.abs(change).max()))
            a, b = a - change[0], b - change[1]
        self.slope, self.shift = float(a), float(b)
        probability = self.probability(x)
        self.threshold = 1.0
        for sort in np.unique(sorts[y == 1]):
            known = np.sort(probability[(y == 1) & (sorts == sort)])
            total = len(known) + int(lost[sort])
            if total >= min(SORT_ROWS, int((y == 1).sum())):
                over = max(0, int((1 - recall) * total) - int(lost[sort]))
                self.threshold = min(self.threshold, float(known[min(over, len(known) - 1)]))
        return self


_MIXED = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


#: Sorts of findings in the training set: the base ones, keys of usual shapes, and short
#: ones, such of letters alone, and dotted ones.
SORTS = ("assign", "access", "hex", "key", "short", "letters", "dotted")


def labelled_findings(texts: list[str | None], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows and labels (1: secret) of ``labelled_tokens``."""
    return labelled_tokens(texts, seed)[:2]


def labelled_tokens(
    texts: list[str | None], seed: int = 3
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows, labels (1: secret), sorts and checksums of tokens made from texts, as
    ``find`` gives the candidates.

    A secret that is no candidate has an empty window. Secrets are the base findings of
    the texts, each also with the surroundings of some other place, so that the token
    itself has to be learned, and random keys of usual shapes there. What is no secret: the texts' own other candidates that are plain
    numbers or words, words behind the names, and numbers, dates, paths, versions and
    joined words.
    """
    draw = np.random.default_rng(seed)
    found = find(pa.array(texts, pa.large_string()))
    pick = lambda letters, n: "".join(letters[i] for i in draw.integers(0, len(letters), n))
    words = [w for t in texts[:400] if t for w in t.split()[:60] if w.isalpha()] or ["word"]
    word = lambda: words[int(draw.integers(len(words)))]
    examples: list[tuple[str, str, str, int, int]] = []

    def around(token, label, name=None, sort=0):
        left = " ".join([word(), word()]) + (name or " ")
        examples.append((left, token, " " + word(), label, sort))

    names = (" key = ", ' auth: "', " Bearer ", " credential=", " pass: ", " pwd=", " key:", " -k ", " ")
    for t, spans in enumerate(found.base):
        text = texts[t] or ""
        for a, b, kind in spans:
            token = text[a:b]
            if kind == "assign":
                token = ASSIGN.match(token).group(2)
                a = b - len(token)
            sort = SORTS.index(kind)
            examples.append((text[max(0, a - BEFORE) : a], token, text[b : b + BEHIND], 1, sort))
            around(token, 1, names[int(draw.integers(len(names)))], sort)
    for _ in range(700):
        n = int(draw.integers(16, 64))
        token = (
            pick(_MIXED, n),
            pick("0123456789abcdef", max(24, n)),
            pick("0123456789ABCDEF", max(24, n)),
            "AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16),
            pick(_MIXED + "+/", n) + "==",
            "sk_" + pick(_MIXED, n),
        )[int(draw.integers(6))]
        around(token, 1, names[int(draw.integers(len(names)))], SORTS.index("key"))
    for _ in range(1000):
        # Short ones and such of letters alone, behind a name; dotted ones anywhere.
        n = int(draw.integers(6, 16))
        sort = int(draw.integers(3))
        token = (
            pick(_MIXED, n),
            pick(_MIXED[:52], int(draw.integers(8, 40))),
            ".".join(pick(_MIXED, int(draw.integers(4, 12))) for _ in range(3)),
        )[sort]
        name = names[int(draw.integers(len(names) - ("." not in token)))]
        around(token, 1, name, SORTS.index("short") + sort)
    own = draw.permutation(len(found.begin))
    plain = 0
    for k in own:
        if plain == PLAIN:
            break
        t, a, b = int(found.text[k]), int(found.begin[k]), int(found.end[k])
        token = found.raw[a:b].tobytes().decode()
        o = found.offsets
        if _PLAIN.fullmatch(token) and not _NAMED.search(found.raw[max(o[t], a - BEFORE) : b].tobytes().decode("latin-1")):
            left = found.raw[max(o[t], a - BEFORE) : a].tobytes().decode(errors="ignore")
            right = found.raw[b : min(o[t + 1], b + BEHIND)].tobytes().decode(errors="ignore")
            examples.append((left, token, right, 0, 0))
            plain += 1
    for _ in range(300):
        around(word(), 0, names[int(draw.integers(len(names)))])
    for _ in range(1000):
        number = str(int(draw.integers(0, 10**18))).zfill(16)
        token = (
            number[:16],
            f"20{draw.integers(10, 30)}-{draw.integers(10, 13)}-{draw.integers(10, 29)}-{number[:8]}",
            f"/{word()}/{word()}/{draw.integers(10, 9999)}/{word()}",
            f"{word()}-{word()}-{word()}-{draw.integers(10, 9999)}",
            f"{word()}_{word()}{draw.integers(10, 99)}_{word()}",
            f"{number[:4]}-{number[4:8]}-{number[8:12]}-{number[12:16]}",
            f"{word()}{word()}{word()}{draw.integers(10, 999)}",
            "=" * int(draw.integers(8, 20)) + number[:2] + "-" * 8,
        )[int(draw.integers(8))]
        around(token, 0)
    # As the scan sees them: the candidate that has most of the token.
    found = find(pa.array([a + b + c for a, b, c, *_ in examples], pa.large_string()), free_only=False)
    at = found.offsets[:-1] + [len(left.encode()) for left, *_ in examples]
    to = at + [len(token.encode()) for _, token, *_ in examples]
    checksums = np.array([zlib.crc32(token.encode()) for _, token, *_ in examples], np.int64)
    both = np.minimum(found.end, to[found.text]) - np.maximum(found.begin, at[found.text])
    most = np.full(len(examples), -1, np.int64)
    for k in np.argsort(both, kind="stable"):
        if both[k] > 0:
            most[found.text[k]] = k
    labels = np.array([label for *_, label, _ in examples], np.float32)
    sorts = np.array([sort for *_, sort in examples], np.int64)
    x = np.full((len(examples), WIDTH), _NONE, np.uint8)
    some = most[most >= 0]
    x[most >= 0] = windows(found.raw, found.offsets, found.text[some], found.begin[some], found.end[some])
    kept = (labels == 1) | (most >= 0)
    return x[kept], labels[kept], sorts[kept], checksums[kept]


def sample_texts(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> list[str]:
    """At most ``rows`` different texts of at most ``SAMPLE_TEXT_BYTES``, by a hash of them.

    A bound on the hash that the number of rows gives leaves about as many texts as are
    wanted; only those, each once, are sent anywhere.
    """
    fit = docs.select(F.col(text).alias("text")).filter(F.octet_length(text) <= SAMPLE_TEXT_BYTES)
    total = max(1, docs.count())
    low, high = -(1 << 63), (1 << 63) - 1
    bound = min(high, low + (1 << 64) * rows * 5 // (4 * total))
    chosen = fit.withColumn("h", F.xxhash64("text")).filter(F.col("h") <= F.lit(bound))
    return [row["text"] for row in chosen.distinct().orderBy("h", "text").limit(rows).collect()]


def train(docs: DataFrame, text: str = "text") -> CharNet:
    """Train on the findings of ``sample_texts``.

    The findings of a fifth of all tokens, wherever they stand, are kept for calibration
    and the threshold, so no token that was trained on is measured.
    """
    x, y, sorts, tokens = labelled_tokens(sample_texts(docs, text))
    held = tokens % 5 == 4
    net = CharNet().fit(x[~held], y[~held])
    return net.calibrate(x[held], y[held], sorts=sorts[held])


def _spans(found: Found, net: CharNet) -> list[list[tuple[int, int, str]]]:
    spans = [list(s) for s in found.base]
    for at in range(0, len(found.begin), 4096):
        part = slice(at, at + 4096)
        text, begin, end = found.text[part], found.begin[part], found.end[part]
        x = windows(found.raw, found.offsets, text, begin, end)
        for i in np.flatnonzero(net.probability(x) >= net.threshold):
            start = int(found.start[part][i])
            spans[text[i]].append((start, start + int(end[i] - begin[i]), "learned"))
    for s in spans:
        s.sort(key=lambda x: (x[0], KINDS.index(x[2])))
    return spans


_SPAN = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("kind", T.StringType()),
        ]
    )
)
_ARROW_SPAN = pa.list_(
    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
)


def scan(docs: DataFrame, net: CharNet, text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with the column ``out``: start, end (code points) and kind of all findings.

    Sorted by start, then kind; empty for null and empty texts. A column named ``out`` is
    replaced.
    """
    kept = [c for c in docs.columns if c != out]
    base = docs.select(*kept)
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in slices(batches, text, SLICE_BYTES):
            found = find(batch.column(batch.schema.get_field_index(text)))
            rows = [
                [{"start": a, "end": b, "kind": k} for a, b, k in spans]
                for spans in _spans(found, sent.value)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, _ARROW_SPAN)], [*batch.schema.names, out]
            )

    schema = T.StructType([*base.schema.fields, T.StructField(out, _SPAN)])
    return base.mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_learned, base_sha256 and spans for every document."""
    found = scan(docs.select("doc_id", "text"), train(docs)).drop("text")
    name = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    joined = lambda spans: F.concat_ws(",", F.transform(spans, name))
    of = lambda kind: F.filter("secrets", lambda s: s["kind"] == kind)
    base = F.filter("secrets", lambda s: s["kind"] != "learned")
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


def mask(docs: DataFrame, text: str = "text", length: str = "n_chars", put: str = "[secret]") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``put``; texts without stay as they are.

    Overlapping findings are one. A column named ``length`` gets the new number of
    characters of the texts that change. The columns stay the same.
    """
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, text))

    # Found and replaced in one pass, as every further pass would be one more Python
    # worker beside each task.
    def run(batches):
        for batch in slices(batches, text, SLICE_BYTES):
            where = batch.schema.get_field_index(text)
            spans = _spans(find(batch.column(where)), sent.value)
            columns = list(batch.columns)
            hit = [i for i, s in enumerate(spans) if s]
            if hit:
                texts = columns[where].to_pylist()
                at = batch.schema.get_field_index(length)
                lengths = columns[at].to_pylist() if at >= 0 else None
                for i in hit:
                    texts[i] = _replaced(texts[i], [(a, b) for a, b, _ in spans[i]], put)
                    if lengths is not None:
                        lengths[i] = len(texts[i])
                columns[where] = pa.array(texts, columns[where].type)
                if lengths is not None:
                    columns[at] = pa.array(lengths, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def _replaced(text: str, spans: list[tuple[int, int]], put: str) -> str:
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], put]
        at = max(at, end)
    return "".join([*out, text[at:]])


def digest(spans: list[tuple[int, int, str]]) -> str:
    """The checksum of findings that ``report`` gives, for tests and for other readers."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()
