"""Vector bin packing of token sequences under simultaneous limits.

Every example is a vector (tokens, segments, loss-bearing tokens). The open sequence has a vector of what it can still
take; of a window of waiting pieces the one with the largest dot product of the two goes in next, and when none fits
whole, the largest is cut. Each task packs its own rows, in memory bounded by
the window and, where pieces are short, by a sequence's tokens.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from encore.llm.common import slices, map_batches

LENGTH = 4096
END = 2
#: Pieces that wait to be placed, or more of short ones, so that they fill a sequence.
WINDOW = 256
#: Distinct chunks of text, and their characters, that a worker remembers the tokens of.
CACHED, CACHED_CHARS = 1_000_000, 10_000_000


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: A lower-case Latin word with marks behind it, or marks alone.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")
#: Byte-level vocabularies show printable Latin-1 bytes as themselves and the others from U+0100 on.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class _Known(dict):
    """Ids of chunks; those of a new one are made when they are first asked for, so that a text takes one pass."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__({"": b""})
        self.make = make

    def __missing__(self, chunk: str) -> bytes:
        made = self[chunk] = self.make(chunk)
        return made


class Encoder:
    """Token ids, as little-endian unsigned 32-bit bytes, of a lower-casing tokenizer that never joins over white space.

    Texts are cut at white space and every distinct chunk is encoded once. A chunk that is a Latin word, with or
    without marks behind it, goes to the vocabulary's merges at once (if probes show that this tokenizer treats it so);
    the others go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # between the names of special tokens all is ordinary text
        self.merge = self.tokenizer.model.tokenize
        self.bytes_of = [pack_ids("<I", i) for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: self.bytes_of[i] for i, t in added.items() if t.special}
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.names = re.compile(f"({'|'.join(names)})") if names else None
        self.direct = True
        self.forget()
        probes = ["the", "thething,", "ééàñüßöÿ.", "straßen?!", "ñandú***", "$$", "a|", "xin#%&.,"]
        self.direct = all(self.known[p] == self._whole(p) == self._whole(p.upper().replace("SS", "ß")) for p in probes)
        self.forget()

    def forget(self) -> None:
        self.known = _Known(self._chunk)
        self.words: dict[str, bytes] = {"": b""}
        self.chars = 0

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)
        bytes_of = self.bytes_of
        made = self.words[word] = b"".join([bytes_of[t.id] for t in self.merge(shown)])
        return made

    def _chunk(self, chunk: str) -> bytes:
        self.chars += len(chunk)
        m = self.direct and _PLAIN.fullmatch(chunk)
        if not m:
            return self._whole(chunk)
        word, marks = m.groups()
        words = self.words
        ids = words.get(word)
        if ids is None:
            ids = self._word(word)
        if marks:
            ids += words[marks] if marks in words else self._word(marks)
        return ids

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text; null has none.

        The name of a special token in a text, as it is written, is that token, as the tokenizer has it.
        """
        special = self.special
        for t in texts:
            if len(self.known) + len(self.words) > CACHED or self.chars > CACHED_CHARS:
                self.forget()
            known = self.known.__getitem__
            if t and any(name in t for name in special):
                parts = self.names.split(t)
                yield b"".join(special[p] if i % 2 else b"".join(map(known, self._chunks(p))) for i, p in enumerate(parts))
            else:
                yield b"".join(map(known, self._chunks(t or "")))

    def _chunks(self, text: str) -> list[str]:
        text = text.lower() if self.direct and "Σ" not in text else text  # its lower case depends on what follows
        return text.replace("\n", " ").replace("\t", " ").split(" ")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process; the tokenizer is read once."""
    return Encoder(path)


class Packer:
    """Places pieces; closed sequences are lists of (row, start, length, offset)."""

    def __init__(self, length: int, segments: int, loss: int, window: int) -> None:
        self.limit = np.array([length, segments, loss], float)
        self.window = window
        self.rows: list[tuple] = []  # (row, start, length, bears loss)
        self.size = np.zeros((window + 1, 3))
        self.n = self.waiting = 0  # pieces, and their tokens

    def add(self, row: object, start: int, length: int, loss: bool) -> None:
        self.rows.append((row, start, length, loss))
        if self.n == len(self.size):
            self.size = np.vstack((self.size, np.zeros_like(self.size)))
        self.size[self.n] = np.array([length, 1, length * loss]) / self.limit
        self.n += 1
        self.waiting += length

    def _take(self, i: int, length: int) -> tuple:
        """Takes ``length`` tokens from the front of piece ``i``; the rest waits on."""
        row, start, whole, loss = self.rows[i]
        self.waiting -= length
        if length == whole:
            self.n -= 1
            self.rows[i] = self.rows[self.n]
            self.rows.pop()
            self.size[i] = self.size[self.n]
        else:
            self.rows[i] = (row, start + length, whole - length, loss)
            self.size[i] = np.array([whole - length, 1, (whole - length) * loss]) / self.limit
        return row, start, length

    def one(self, most: int | None = None) -> list[tuple]:
        """The next sequence, of ``most`` tokens at most."""
        room = np.ones(3)
        if most is not None:
            room[0] = most / self.limit[0]
        out, offset, left = [], 0, most or int(self.limit[0])
        small = 0.5 / self.limit.max()
        while self.n and left and room[1] > small:
            size = self.size[: self.n]
            dots = size @ room
            fits = (size <= room + 1e-12).all(1)
            if fits.any():
                i = int(np.argmax(np.where(fits, dots, -1.0)))
                length = self.rows[i][2]
            else:
                i = int(np.argmax(dots))
                length = min(left, self.rows[i][2])
                if self.rows[i][3]:
                    length = min(length, int(round(room[2] * self.limit[2])))
                if not length:
                    break
            loss = self.rows[i][3]
            row, start, length = self._take(i, length)
            out.append((row, start, length, offset))
            offset, left = offset + length, left - length
            room -= np.array([length, 1, length * loss]) / self.limit
        return out

    def ready(self) -> Iterator[list[tuple]]:
        while self.n >= self.window and self.waiting >= self.limit[0]:
            yield self.one()

    def rest(self) -> Iterator[list[tuple]]:
        """What waits at the end: full sequences, then one for each power of two in the remaining count."""
        length = int(self.limit[0])
        while self.n:
            yield self.one(length if self.waiting >= length else 1 << (self.waiting.bit_length() - 1))


def pack(
    rows: DataFrame, row_id: str = "doc_id", text: str = "text", loss: str | None = None, tokenizer: str | None = None,
    length: int = LENGTH, segments: int | None = None, loss_tokens: int | None = None, end: int = END, window: int = WINDOW,
) -> DataFrame:
    """Token pieces packed into sequences of at most ``length`` tokens, ``segments`` pieces (default: as many as fit) and
    ``loss_tokens`` tokens that bear loss (default: ``length``).

    A row's ids are those of its text and then ``end``; a null or empty text has ``end`` alone. The boolean column
    ``loss`` tells whether a row's tokens bear loss (null: no; without the column all do). Rows are cut freely, every
    id is in exactly one piece; copies are packed like other rows. Returns for each piece ``doc_id`` (the value of
    ``row_id``), ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, ``bears_loss``.
    A sequence's number holds its task's and counts up from there. Only a task's last sequences can be short; their
    lengths are powers of two unless the limit on segments ends them.
    """
    kind = rows.schema[row_id].dataType.simpleString()
    path = tokenizer or tokenizer_path()
    most_loss = loss_tokens or length
    schema = (
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bears_loss boolean"
    )
    names = [x.split()[0] for x in schema.split(", ")]
    chosen = rows.select(rows[row_id].alias("i"), rows[text].alias("t"), *([rows[loss].alias("l")] if loss else []))
    mark = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encode = encoder(path)
        packer = Packer(length, segments or length, most_loss, window)
        sequence = pyspark.TaskContext.get().partitionId() << 33
        out = {n: [] for n in names}

        def put(pieces: list[tuple]) -> None:
            nonlocal sequence
            for (key, ids, bears), start, n, offset in pieces:
                values = (key, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), len(ids) // 4, sequence, offset, bears)
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)
            sequence += 1

        for batch in slices(batches):
            keys, texts = batch.column("i").to_pylist(), batch.column("t").to_pylist()
            bear = batch.column("l").to_pylist() if loss else [True] * len(keys)
            for key, ids, bears in zip(keys, encode.encode(texts), bear, strict=True):
                ids += mark
                whole = (key, ids, bool(bears))
                for start in range(0, len(ids) // 4, length):
                    packer.add(whole, start, min(length, len(ids) // 4 - start), bool(bears))
                for pieces in packer.ready():
                    put(pieces)
            yield out
            out = {n: [] for n in names}
        for pieces in packer.rest():
            put(pieces)
        encode.forget()  # the worker goes on to other tasks
        yield out

    return map_batches(chosen, schema, run)
