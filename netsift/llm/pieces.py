"""SentencePiece encoding that keeps the source bytes of every piece.

A text is normalised by the model's compiled character map (a double-array trie): at each place the longest
rule wins, else the character stays, and every byte written remembers the source byte it came from.  Pieces are
cut from the normalised text, so each projects to a span of source bytes.  With an identity map a text falls into
blank-led words that the model encodes on their own, once per worker; with other maps texts are encoded whole.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from netsift.llm import kernel

MARK = "▁"
WORDS_KEPT = 250_000


def fields(message: bytes):
    """(number, value) of a protocol buffer message's fields."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else 8 if kind == 1 else 4
            yield tag >> 3, message[at:at + n]
            at += n


@dataclass(frozen=True)
class Normalizer:
    """Settings of a model's normaliser: its compiled map and how it treats blanks."""

    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @staticmethod
    def of_spec(spec: bytes) -> Normalizer:
        got = dict(fields(spec))
        return Normalizer(bytes(got.get(2, b"")), bool(got.get(3, 1)), bool(got.get(4, 1)), bool(got.get(5, 1)))

    @staticmethod
    def of_model(model: bytes) -> Normalizer:
        return Normalizer.of_spec(next((v for n, v in fields(model) if n == 3), b""))

    def rules(self):
        if not self.charsmap:
            return np.zeros(0, np.uint32), b""
        n = struct.unpack("<I", self.charsmap[:4])[0]
        return np.frombuffer(self.charsmap, "<u4", n // 4, 4), self.charsmap[4 + n:]

    def longest(self, source: bytes, at: int) -> tuple[bytes, int]:
        """Replacement and source length of the longest rule at a place, else the character itself."""
        units, strings = self.rules()
        best, node = None, 0
        if len(units):
            unit = int(units[0])
            node = (unit >> 10) << ((unit & (1 << 9)) >> 6)
            for k in range(at, len(source)):
                node ^= source[k]
                unit = int(units[node])
                if unit & 0x800000FF != source[k]:
                    break
                node ^= (unit >> 10) << ((unit & (1 << 9)) >> 6)
                if (unit >> 8) & 1:
                    best = (int(units[node]) & 0x7FFFFFFF, k + 1 - at)
        if best is not None:
            end = strings.index(b"\0", best[0])
            return strings[best[0]:end], best[1]
        lead = source[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return source[at:at + n], n

    def __call__(self, text: str) -> tuple[bytes, list[int]]:
        """Normalised bytes, and per byte (and for the end) the source byte it comes from."""
        source = text.encode()
        blank = MARK.encode() if self.escape else b" "
        steps, at = [], 0
        while at < len(source):
            new, n = self.longest(source, at)
            steps.append((new, at, n))
            at += n
        if self.squeeze:
            while steps and steps[0][0] == b" ":
                steps.pop(0)
        out, align = bytearray(), []

        def put(part: bytes, where: int):
            out.extend(part)
            align.extend([where] * len(part))

        if not steps:
            return b"", [len(source) if not self.squeeze else 0]
        if self.dummy_prefix:
            put(blank, steps[0][1])
        spaced = self.squeeze
        end = steps[-1][1] + steps[-1][2]
        for new, where, _ in steps:
            if spaced:
                new = new.lstrip(b" ")
            for k in range(len(new)):
                put(blank if new[k:k + 1] == b" " else new[k:k + 1], where)
            if new:
                spaced = self.squeeze and new.endswith(b" ")
        if self.squeeze:
            while out.endswith(blank):
                del out[-len(blank):]
                end = align[-len(blank)]
                del align[-len(blank):]
        return bytes(out), [*align, end]


class PieceEncoder:
    """A model with a bounded memory of words."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            model = f.read()
        self.normalizer = Normalizer.of_model(model)
        n = self.processor.get_piece_size()
        byte = np.array([self.processor.is_byte(k) for k in range(n)])
        self.byte = byte
        self.size = np.array([1 if byte[k] else len(self.processor.id_to_piece(k).encode()) for k in range(n)])
        # words stand alone if the map is empty, no piece has a mark behind another character, and all pieces are plain
        inner = any(MARK in self.processor.id_to_piece(k).lstrip(MARK) for k in range(n))
        s = self.normalizer
        self.by_word = not s.charsmap and s.dummy_prefix and not s.squeeze and s.escape and not inner
        self.mark = self.processor.piece_to_id(MARK)
        self.words: dict[str, bytes] = {}

    def learn(self, words: list[str]) -> None:
        if len(self.words) + len(words) > WORDS_KEPT:
            self.words.clear()
        for word, ids in zip(words, self.processor.encode(words, num_threads=1)):
            self.words[word] = np.array(ids or [self.mark], "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """Ids of a text without begin and end, as little-endian 32-bit numbers."""
        if not text:
            return b""
        if not self.by_word or MARK in text or "\0" in text:
            return np.array(self.processor.encode(text, num_threads=1), "<u4").tobytes()
        if "  " in text or text[0] == " " or text[-1] == " ":
            words = [w[1:] for w in re.findall(" *[^ ]+| +$", " " + text)]
        else:
            words = text.split(" ")
        new = [w for w in set(words) if w not in self.words]
        if new:
            self.learn(new)
            if any(w not in self.words for w in words):
                self.learn(list(set(words)))
        return b"".join(map(self.words.__getitem__, words))

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source byte spans of a text's pieces; together they cover what the normaliser kept.

        Byte pieces of one character: the last carries the character, those before it are empty.
        """
        size = self.size[ids]
        if self.by_word and MARK not in text:
            # a mark is three bytes in a piece and one blank in the source; the dummy prefix is none
            size = size - 2 * self.marks[ids]
            end = np.maximum(np.cumsum(size) - 1, 0)
        else:
            norm, align = self.normalizer(text)
            if self.normalizer.charsmap and int(size.sum()) != len(norm):
                size = self._sizes(ids, norm)
            end = np.array(align)[np.minimum(np.cumsum(size), len(norm))]
        begin = np.concatenate([[0], end[:-1]]) if len(end) else end
        for k in np.flatnonzero(self.byte[ids]):
            n = k
            while n + 1 < len(ids) and self.byte[ids[n + 1]] and not self._starts(ids[n + 1]):
                n += 1
            if n > k:
                end[k] = begin[k + 1] = begin[k]
        return begin, end

    def _starts(self, k: int) -> bool:
        value = int(self.processor.id_to_piece(int(k))[3:5], 16)
        return value & 0xC0 != 0x80

    def _sizes(self, ids: np.ndarray, norm: bytes) -> np.ndarray:
        """Piece lengths where the unknown piece stands for characters that have none."""
        unknown, out, at = self.processor.unk_id(), [], 0
        for n, k in enumerate(ids):
            width = int(self.size[k])
            if k == unknown:
                follow = self.processor.id_to_piece(int(ids[n + 1])).encode() if n + 1 < len(ids) else None
                stop = norm.find(follow, at + 1) if follow else len(norm)
                width = (stop if stop > 0 else len(norm)) - at
            out.append(width)
            at += width
        return np.array(out)

    @property
    def marks(self) -> np.ndarray:
        if not hasattr(self, "_marks"):
            self._marks = np.array([0 if self.byte[k] else self.processor.id_to_piece(k).count(MARK)
                                    for k in range(len(self.size))])
        return self._marks


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a model file; it lives across tasks."""
    store = kernel.worker_store()
    have = getattr(store, "pieces", None)
    if have is None:
        have = store.pieces = {}
    if path not in have:
        have[path] = PieceEncoder(path)
    return have[path]


def encode(docs: DataFrame, model: str, digest: bool = False) -> DataFrame:
    """One row per input row: doc_id, ids (with begin and end), begins and ends (source bytes per piece), decoded.

    Begin and end ids have empty spans.  Null text counts as empty.  With ``digest``, the row holds n_tokens,
    ids_sha256, decoded_sha256 and spans_crc32 (of begins, then ends, as 64-bit numbers) instead.
    """
    def make():
        import hashlib
        import zlib

        import pyarrow as pa

        own = encoder(model)
        bos, eos = own.processor.bos_id(), own.processor.eos_id()

        def work(data, off, null):
            raw = data.tobytes()
            rows = []
            for k in range(len(off) - 1):
                text = raw[off[k]:off[k + 1]].decode()
                ids = np.frombuffer(own.ids(text), "<u4")
                begin, end = own.spans(text, ids)
                last = end[-1:] if len(end) else np.zeros(1, int)
                whole = np.concatenate([[bos], ids, [eos]]).astype("<u4")
                begin, end = np.concatenate([[0], begin, last]), np.concatenate([[0], end, last])
                decoded = own.processor.decode(whole.tolist())
                if digest:
                    rows.append((len(whole), hashlib.sha256(whole.tobytes()).hexdigest(),
                                 hashlib.sha256(decoded.encode()).hexdigest(),
                                 zlib.crc32(end.astype("<i8").tobytes(), zlib.crc32(begin.astype("<i8").tobytes()))))
                else:
                    rows.append((whole.astype(np.int64), begin, end, decoded))
            cols = list(zip(*rows)) or [[], [], [], []]
            kinds = ([pa.int64(), pa.string(), pa.string(), pa.int64()] if digest else
                     [pa.list_(pa.int64())] * 3 + [pa.string()])
            return [pa.array(c, t) for c, t in zip(cols, kinds)]

        return work

    shape = ("n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long" if digest else
             "ids array<long>, begins array<long>, ends array<long>, decoded string")
    return kernel.map_texts(docs, make, shape)
