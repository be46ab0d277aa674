"""Token ids of whole texts by a tokenizer file, at the cost of the distinct words.

Texts are cut before every space, and around every newline, that follows no white space,
where no token of the supported tokenizers runs across. Each distinct piece of a slice of texts is then
tokenized once, and frequent pieces once per worker.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

END_ID = 2
SLICE_BYTES = 4 << 20
_CACHED = 250_000
_BATCH = 4096
# Everything that any of the libraries takes for white space, and then some.
_WHITE = (
    "\t-\r\x1c-\x20\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u2060\u3000\ufeff"
)
_MARK = "\x01"
_ODD = f"[{_WHITE}][ \n]|\n[{_WHITE}]|{_MARK}"
_CUT = re.compile(f"(?<=[^{_WHITE}])(?= )")

# A word of these letters and the marks behind it are tokens apart, for every tokenizer
# whose probes below succeed. Letters are those of Latin-1, in their composed form.
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_MARKS = ".,;:!?$%&#*|"
_PLAIN = f"^ ?[{_LETTERS}]+[{_MARKS}]*$"

_loaded: dict[str, "PieceEncoder"] = {}


_ALL_LETTERS = " " + "".join(c for c in map(chr, range(256)) if re.match(f"[{_LETTERS}]", c))


def _byte_level() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it
    is visible, else the next one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, beyond = [], 256
    for b in range(256):
        out.append(chr(b if b in visible else beyond))
        beyond += b not in visible
    return out


_BYTE_LEVEL = _byte_level()


def encoder(path: str) -> "PieceEncoder":
    """The encoder of a tokenizer file, loaded once per worker."""
    if path not in _loaded:
        _loaded[path] = PieceEncoder(path)
    return _loaded[path]


class PieceEncoder:
    """Encodes texts piece by piece; equal to encoding each text at once.

    For tokenizers whose pre-tokenizer never joins a space to the characters before
    it, with or without leading spaces in their tokens.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spell = self._spelling()
        # Two generations: what was not asked for while one filled up is forgotten.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _spelling(self):
        """How the model is given a plain word, found out by trial; None if in neither way."""
        table = {c: "".join(_BYTE_LEVEL[b] for b in chr(c).encode()) for c in range(256)}
        space = table[32]

        def spelled(words: pa.Array, shown: pa.Array) -> list[str]:
            out = shown.to_pylist()
            for i in np.flatnonzero(~pc.string_is_ascii(words).to_numpy(zero_copy_only=False)):
                out[i] = out[i].translate(upper)
            return out

        def exact(words: pa.Array) -> list[str]:
            return spelled(words, pc.replace_substring(words, " ", space))

        def lower(words: pa.Array) -> list[str]:
            return spelled(words, pc.utf8_lower(pc.utf8_ltrim(words, " ")))

        upper = {c: t for c, t in table.items() if c >= 128}
        upper[ord(space)] = space
        probes = [" Thanedble", "Vier", " \xe9t\xc9s", "!!", " stra\xdfe", "a", " I", "$$$", "%"]
        for spell in (exact, lower):
            if all(
                [t.id for t in self.model.tokenize(shown)]
                == self.tokenizer.encode(p, add_special_tokens=False).ids
                for p, shown in zip(probes, spell(pa.array(probes, pa.large_string())))
            ):
                return spell
        return None

    def _ids_of(self, pieces: pa.Array, whole: bool) -> list[bytes]:
        """Ids of distinct pieces; those that are not ``whole`` are plain words or marks."""
        names = pieces.to_pylist()
        young, old = self.young, self.old
        get = young.get
        out = [get(p) for p in names]
        missing = []
        for i, found in enumerate(out):
            if found is None:
                found = old.get(names[i])
                if found is None:
                    missing.append(i)
                else:
                    out[i] = young[names[i]] = found
        if whole:
            for at in range(0, len(missing), _BATCH):
                part = missing[at : at + _BATCH]
                encoded = self.tokenizer.encode_batch_fast(
                    [names[i] for i in part], add_special_tokens=False
                )
                for i, one in zip(part, encoded):
                    out[i] = array("I", one.ids).tobytes()
        elif missing:
            tokenize = self.model.tokenize
            for i, shown in zip(missing, self.spell(pieces.take(pa.array(missing)))):
                out[i] = array("I", [t.id for t in tokenize(shown)]).tobytes()
        for i in missing:
            if len(names[i]) < 64:
                young[names[i]] = out[i]
        if len(young) > _CACHED:
            self.young, self.old = {}, young
        return out

    def _bank(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all distinct ``pieces``, and where those of each start and how many they are."""
        plain = np.zeros(len(pieces), bool)
        if self.spell is not None:
            plain = pc.match_substring_regex(pieces, _PLAIN).to_numpy(zero_copy_only=False)
        words = pieces.filter(pa.array(plain))
        marks = pc.utf8_ltrim(words, _ALL_LETTERS).dictionary_encode()
        words = pc.utf8_rtrim(words, _MARKS).dictionary_encode()
        parts = [
            *self._ids_of(words.dictionary, False),
            *self._ids_of(marks.dictionary.filter(pc.greater(pc.binary_length(marks.dictionary), 0)), False),
            *self._ids_of(pieces.filter(pa.array(~plain)), True),
        ]
        # Each piece is a word and marks, of which either may be nothing.
        sizes = np.array([*map(len, parts), 0], np.int64) // 4
        flat = np.frombuffer(b"".join(parts), np.uint32)
        starts = np.cumsum(sizes) - sizes
        nothing = len(parts)
        pair = np.full((len(pieces), 2), nothing, np.int64)
        pair[plain, 0] = words.indices.to_numpy()
        empty = pc.equal(pc.binary_length(marks.dictionary), 0).to_numpy(zero_copy_only=False)
        number = np.where(empty, nothing, len(words.dictionary) + np.cumsum(~empty) - 1)
        pair[plain, 1] = number[marks.indices.to_numpy()]
        others = int((~plain).sum())
        pair[~plain, 0] = nothing - others + np.arange(others)
        ids = flat[_ranges(starts[pair.reshape(-1)], sizes[pair.reshape(-1)])]
        total = sizes[pair].sum(1)
        return ids, np.cumsum(total) - total, total

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one behind the other, and the n + 1 offsets of the texts; null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~odd))
        marked = pc.replace_substring(plain, " ", _MARK + " ")
        marked = pc.replace_substring(marked, "\n", f"{_MARK}\n{_MARK}")
        lists = pc.split_pattern(marked, _MARK)
        counts = np.zeros(len(texts), np.int64)
        counts[~odd] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        others = [_CUT.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        counts[odd] = [len(x) for x in others]
        flat = [lists.flatten(), pa.array([p for x in others for p in x], pa.large_string())]
        words = pa.concat_arrays(flat).dictionary_encode()
        # Pieces lie in the order plain texts, odd texts; bring them into that of the texts.
        order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
        first = np.zeros(len(texts), np.int64)
        first[order] = np.cumsum(counts[order]) - counts[order]
        codes = words.indices.to_numpy(zero_copy_only=False)[_ranges(first, counts)]
        bank, starts, sizes = self._bank(words.dictionary)
        ids = bank[_ranges(starts[codes], sizes[codes])]
        per_text = np.zeros(len(texts) + 1, np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])
        per_text[1:] = ends[np.cumsum(counts)]
        return ids, per_text


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count numbers) for each pair, one behind the other."""
    total = int(counts.sum())
    out = np.arange(total, dtype=np.int64)
    out += np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return out


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``end`` appended to each text's ids."""
    where = offsets[1:]
    return np.insert(ids, where, end), offsets + np.arange(len(offsets))


def narrow(path: str, end: int = END_ID) -> bool:
    """True if two bytes hold every id of the tokenizer."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    return max([end, *vocabulary.values()]) < 1 << 16


def binaries(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One binary value per row from an array and its n + 1 row offsets."""
    ends = pa.py_buffer((offsets * values.itemsize).astype(np.int32).tobytes())
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, ends, data])


def tokenized(
    docs: DataFrame, path: str, text: str = "text", end: int = END_ID, counted: bool = False
) -> DataFrame:
    """``docs`` with ``text`` replaced by n_tokens and ids (little-endian, two or four bytes).

    A null or empty text has the end id alone. If ``counted``, the column ``counts`` of
    some rows has the ids of several rows with their numbers, each occurrence in one of
    them: four-byte ids, then as many eight-byte numbers.
    """
    kind = np.uint16 if narrow(path, end) else np.uint32
    kept = [f for f in docs.schema.fields if f.name not in (text, "n_tokens", "ids", "counts")]
    new = {"n_tokens": T.LongType(), "ids": T.BinaryType()}
    if counted:
        new["counts"] = T.BinaryType()
    schema = T.StructType([*kept, *(T.StructField(name, t) for name, t in new.items())])

    def run(batches):
        tool = encoder(path)
        for batch in slices(batches, text, SLICE_BYTES):
            ids, offsets = tool.encode(batch.column(batch.schema.get_field_index(text)))
            ids, offsets = with_end(ids, offsets, end)
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            columns += [pa.array(np.diff(offsets)), binaries(ids.astype(kind), offsets)]
            if counted:
                number = np.bincount(ids)
                used = np.flatnonzero(number)
                data = used.astype(np.uint32).tobytes() + number[used].astype(np.int64).tobytes()
                columns.append(pa.array([data] + [None] * (batch.num_rows - 1), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    names = [f.name for f in kept]
    return docs.select(*names, F.col(text)).mapInArrow(run, schema)


def id_type(path: str, end: int = END_ID):
    return np.uint16 if narrow(path, end) else np.uint32
