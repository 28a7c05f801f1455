"""Offset-preserving SentencePiece encoding and decoding.

Text is normalised by longest-prefix matching through the model's compiled character map (a double-array trie over
UTF-8 bytes), and every normalised byte remembers the source bytes it came from; so each piece projects back to a
span of original bytes.  Where the model has no map, every character is its own longest prefix, and the same rule is
carried out on whole groups of texts as arrays.  When no piece of the vocabulary holds a word-start mark after another
character, merges never cross such a mark and the text is encoded mark by mark, with a memo of stretches met before;
the library encodes each stretch.  Other vocabularies are encoded and aligned whole.  Workers keep their codec by path.

Defined results: null text counts as empty (the end id alone, decoded to the empty text); repeated rows give repeated
rows; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import re
import struct
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_text

MARK = "▁"
_STRETCH = re.compile(f"{MARK}+[^{MARK}]*")
#: Stretches as the source has them; the first has no mark of its own.
_SOURCE = re.compile(f"[ {MARK}]+[^ {MARK}]*|[^ {MARK}]+")
#: Memo entries and the longest stretch kept by one worker; a full memo is emptied, which never changes a result.
MEMO, MEMO_CHARS = 150_000, 64
#: Texts whose new stretches the library encodes in one call.
GROUP, GROUP_CHARS = 256, 1 << 20


class Encoded(NamedTuple):
    ids: list[int]
    starts: list[int]
    ends: list[int]


class Trip(NamedTuple):
    """Ids with the end id, said in decimals; the decoded text; source byte spans, the end id's (empty) included."""

    n: int
    said: str
    made: str
    starts: np.ndarray
    ends: np.ndarray


class CharMap:
    """Longest-prefix replacement through a compiled character map."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0]
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
        self.targets = blob[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(matched length, replacement) of the longest key that starts at ``at``."""
        units, found = self.units, None
        pos = self._offset(units[0])
        for i in range(at, len(data)):
            pos ^= data[i]
            if pos >= len(units) or units[pos] & 0x800000FF != data[i]:
                break
            unit = units[pos]
            pos ^= self._offset(unit)
            if unit >> 8 & 1:
                value = units[pos] & 0x7FFFFFFF
                found = i + 1 - at, self.targets[value : self.targets.index(b"\0", value)]
        return found


class PieceCodec:
    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(open(path, "rb").read())
        norm, train = spec.normalizer_spec, spec.trainer_spec
        self.char_map = CharMap(norm.precompiled_charsmap) if norm.precompiled_charsmap else None
        pieces = spec.pieces
        own = {pieces[0].USER_DEFINED}
        self.apart = (
            norm.add_dummy_prefix
            and not norm.remove_extra_whitespaces
            and norm.escape_whitespaces
            and not train.treat_whitespace_as_suffix
            and train.model_type == train.BPE
            and self.char_map is None
            and not any(p.type in own or MARK in p.piece.lstrip(MARK) for p in pieces)
            and any(p.piece == MARK for p in pieces)
        )
        self.mark_id = self.library.piece_to_id(MARK)
        self.end_id = self.library.eos_id()
        self.norm = norm
        self.byte_ids = frozenset(i for i in range(len(pieces)) if pieces[i].type in (pieces[i].BYTE, pieces[i].UNKNOWN, pieces[i].CONTROL))
        self._ids: dict[str, list[int]] = {}
        self._text: dict[str, tuple[int, str, str, bytes]] = {}
        #: Normalised bytes of each piece; an unknown piece is one character.
        self.sizes = [0 if p.type == p.UNKNOWN else 1 if p.type == p.BYTE else len(p.piece.encode()) for p in pieces]
        self._size_of = np.array(self.sizes, dtype=np.uint16)
        self._is_byte = np.isin(np.arange(len(pieces)), list(self.byte_ids))
        self._said = [str(i) for i in range(len(pieces))]

    # -- normalisation ------------------------------------------------------------------------------------------

    def normalise(self, text: str, start: bool = True) -> tuple[bytes, list[int]]:
        """Normalised bytes (marks for spaces, start mark included) and, for each and the end, its source byte.

        Without ``start``, the text continues another and gets no start mark.
        """
        data = text.encode()
        mark = MARK.encode()
        out, source = bytearray(), []
        if start and self.norm.add_dummy_prefix and data:
            out += mark
            source += [0] * len(mark)
        at = 0
        while at < len(data):
            hit = self.char_map.longest(data, at) if self.char_map else None
            if hit:
                step, made = hit
            else:
                b = data[at]
                step = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
                made = data[at : at + step]
            if self.norm.escape_whitespaces:
                made = made.replace(b" ", mark)
            out += made
            source += [at] * len(made)
            at += step
        source.append(len(data))
        return bytes(out), source

    # -- encoding -----------------------------------------------------------------------------------------------

    def _stretch(self, stretch: str) -> list[int]:
        """Ids of one mark-led stretch; the library adds the first mark itself."""
        ids = self._ids.get(stretch)
        if ids is None:
            ids = self.library.encode(stretch[1:]) if len(stretch) > 1 else [self.mark_id]
            if len(stretch) <= MEMO_CHARS:
                if len(self._ids) > MEMO:
                    self._ids.clear()
                self._ids[stretch] = ids
        return ids

    def stretches(self, text: str) -> list[str]:
        return _STRETCH.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode_ids(self, text: str) -> list[int]:
        """Ids without the end id."""
        if not self.apart:
            return self.library.encode(text)
        return [i for s in self.stretches(text) for i in self._stretch(s)]

    def encode(self, text: str) -> Encoded:
        """Ids without the end id, and the source byte span of each (an inserted mark has an empty span at 0)."""
        return self.align(self.encode_ids(text), text)

    def align(self, ids: list[int], text: str, start: bool = True) -> Encoded:
        """The ids of a text with the source byte span of each, through the normalised text."""
        made, source = self.normalise(text, start)
        starts, ends, at = [], [], 0
        for i in ids:
            size = self.sizes[i]
            if not size:  # unknown: one character of the normalised text
                b = made[at]
                size = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            starts.append(source[at])
            at += size
            ends.append(source[at])
        if at != len(made):
            raise ValueError(f"pieces of {at} bytes for a normalised text of {len(made)}")
        return Encoded(ids, starts, ends)

    def decode(self, ids: list[int]) -> str:
        return self.library.decode([i for i in ids if i != self.end_id])

    def round_trips(self, texts: list[str]) -> list[Trip]:
        """Each text encoded with its source spans, and decoded."""
        end = self.end_id
        if not self.apart:
            found = []
            for text in texts:
                e, n = self.encode(text), len(text.encode())
                found.append(Trip(len(e.ids) + 1, " ".join(map(str, [*e.ids, end])), self.decode(e.ids), np.array([*e.starts, n]), np.array([*e.ends, n])))
            return found
        memo = self._text
        if len(memo) > MEMO:
            memo.clear()
        # "^" leads a text's first stretch, whose mark isn't in the source; all others begin with a space or a mark
        parts = [_SOURCE.findall(t) for t in texts]
        for p in parts:
            if p:
                p[0] = "^" + p[0]
        missing = [s for s in dict.fromkeys(chain.from_iterable(parts)) if s not in memo]
        if missing:
            self._learn(missing)
        rows = [[memo[s] for s in p] for p in parts]
        sizes = np.frombuffer(b"".join([m[3] for r in rows for m in r]), np.uint16)
        if not sizes.all():
            raise ValueError("an unknown piece in a vocabulary that spells bytes")
        counts = [sum([m[0] for m in r]) for r in rows]
        starts, ends = self._group_spans(texts, sizes, counts)
        out, at = [], 0
        for text, r, n in zip(texts, rows, counts):
            if r:
                said = " ".join([m[1] for m in r])
                size = len(text.encode())
                out.append(Trip(n + 1, f"{said} {end}", "".join([m[2] for m in r])[1:], np.append(starts[at : at + n], size), np.append(ends[at : at + n], size)))
                at += n
            else:
                out.append(Trip(1, str(end), "", np.zeros(1, np.int64), np.zeros(1, np.int64)))
        for s in missing:
            if len(s) > MEMO_CHARS:
                del memo[s]
        return out

    def _learn(self, stretches: list[str]) -> None:
        """Remember the stretches' ids (said in decimals), decoding and piece sizes."""
        found = [ids or [self.mark_id] for ids in self.library.encode([s[1:] for s in stretches], num_threads=1)]
        flat = np.array(list(chain.from_iterable(found)), dtype=np.int32)
        ends = np.cumsum([len(ids) for ids in found])
        sizes, odd = self._size_of[flat].tobytes(), np.add.reduceat(self._is_byte[flat].astype(np.int32), np.append(0, ends[:-1])) > 0
        said, memo, at = self._said, self._text, 0
        for s, ids, to, o in zip(stretches, found, ends.tolist(), odd.tolist()):
            # decoding drops one leading mark, which every stretch has; pieces that aren't bytes spell the stretch
            made = " " + (self.library.decode(ids) if o else s[1:].replace(MARK, " "))
            memo[s] = len(ids), " ".join([said[i] for i in ids]), made, sizes[2 * at : 2 * to]
            at = to

    def _group_spans(self, texts: list[str], sizes: np.ndarray, counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Source spans of the pieces of all texts, end to end; ``sizes`` are the pieces' normalised bytes.

        Normalised bytes of the texts are laid out as by ``normalise`` (a mark before each, a mark for every space),
        and each carries its source byte; a piece spans from the source of its first byte to that of the next piece.
        """
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join([b" " + r for r in raw if r]), np.uint8)  # the blank stands for the mark that leads
        index = np.arange(len(data), dtype=np.int64)
        head = np.maximum.accumulate(np.where((data & 0xC0) != 0x80, index, 0))  # each byte's character
        source = np.append(np.repeat(head, np.where(data == 32, len(MARK.encode()), 1)), len(data))
        begin = np.cumsum(sizes, dtype=np.int64)
        if (begin[-1] if len(begin) else 0) != len(source) - 1:
            raise ValueError("pieces that don't add up to the normalised texts")
        ends = source[begin]
        starts = source[begin - sizes]
        at = size = 0
        for r, n in zip(raw, counts):
            if r:
                # places are those of the text itself; the leading mark has an empty span at 0
                starts[at : at + n] = np.maximum(starts[at : at + n] - (size + 1), 0)
                ends[at : at + n] -= size + 1
                at += n
                size += len(r) + 1
                ends[at - 1] = len(r)
        return starts, ends

    def round_trip(self, text: str) -> Trip:
        return self.round_trips([text])[0]


@functools.lru_cache(maxsize=2)
def _codec(path: str | None) -> PieceCodec:
    """A worker's codec: its memo serves all tasks that the worker runs."""
    return PieceCodec(path or default_path())


def _groups(texts: list[str]):
    """Runs of texts of at most GROUP texts and about GROUP_CHARS characters."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if len(group) >= GROUP or size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode_digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256, round_trip (decoded equals the text), spans_sha256.

    The last is of the pieces' source spans: all starts, then all ends, as little-endian 64-bit integers.
    """
    def kernel(part: pa.RecordBatch) -> dict:
        codec = _codec(path)
        n_tokens, ids_sha, text_sha, same, spans_sha = [], [], [], [], []
        texts = [t or "" for t in part.column(1).to_pylist()]
        for group in _groups(texts):
            for text, trip in zip(group, codec.round_trips(group)):
                n_tokens.append(trip.n)
                ids_sha.append(hashlib.sha256(trip.said.encode()).hexdigest())
                text_sha.append(hashlib.sha256(trip.made.encode()).hexdigest())
                same.append(trip.made == text)
                spans_sha.append(hashlib.sha256(np.concatenate([trip.starts, trip.ends]).astype("<i8").tobytes()).hexdigest())
        return {id_col: part.column(0), "n_tokens": pa.array(n_tokens, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string()), "round_trip": pa.array(same, pa.bool_()), "spans_sha256": pa.array(spans_sha, pa.string())}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_text(docs.select(docs[id_col], docs[text_col].alias("text")), kernel, f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean, spans_sha256 string")


def encode_pieces(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids, starts, ends (source byte spans; the end id spans nothing at the text's end)."""
    def kernel(part: pa.RecordBatch) -> dict:
        codec = _codec(path)
        ids, starts, ends = [], [], []
        for text in part.column(1).to_pylist():
            e, n = codec.encode(text or ""), len((text or "").encode())
            ids.append([*e.ids, codec.end_id])
            starts.append([*e.starts, n])
            ends.append([*e.ends, n])
        kind = pa.list_(pa.int32())
        return {id_col: part.column(0), "ids": pa.array(ids, kind), "starts": pa.array(starts, kind), "ends": pa.array(ends, kind)}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_text(docs.select(docs[id_col], docs[text_col].alias("text")), kernel, f"{id_col} {kind}, ids array<int>, starts array<int>, ends array<int>")


def decode_pieces(rows: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The inverse of ``encode_pieces``: id, text (null ids: empty text)."""
    def run(batches):
        for part in batches:
            codec = _codec(path)
            yield pa.RecordBatch.from_pydict({id_col: part.column(0), "text": pa.array([codec.decode(x or []) for x in part.column(1).to_pylist()], pa.string())})

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(rows[id_col], rows[ids_col]).mapInArrow(run, f"{id_col} {kind}, text string")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
