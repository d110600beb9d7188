"""Byte-pair encoding and decoding, exact, by backtracking over longest token matches.

An Aho-Corasick automaton over all token byte strings gives, for every position of a piece of
text, the longest token that begins there. The encoder takes the longest token that may follow
the one before it; which pairs of tokens may stand side by side is decided by a compatibility
table (undoing merges on both sides of the seam shows whether any merge across it would have come
first). Where no token fits, it goes back one token. A position proved a dead end is never tried
again, so the work is linear in the piece. The result is the merge result itself.

Decoding copies token bytes through an offset table: the bytes of all tokens laid end to end, and
where each begins.
"""

from __future__ import annotations

import hashlib
import json
from collections import OrderedDict
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wardflow.llm.common import only, ship_code

#: Pieces a worker remembers; when full, the table is emptied. Only speed depends on it.
PIECES = 300_000
PAIRS = 1_000_000

# Fixed value: the split rule of byte-level encoders, with white space as Unicode defines it.
PIECE_RULE = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
              r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(moved)}}


class Codec:
    """Encoder and decoder for one byte-level vocabulary file (JSON text)."""

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        kind = (spec["model"]["type"], spec["pre_tokenizer"]["type"], spec["normalizer"],
                spec["pre_tokenizer"]["add_prefix_space"], spec["pre_tokenizer"]["use_regex"])
        if kind != ("BPE", "ByteLevel", None, False, True):
            raise ValueError(f"not a plain byte-level vocabulary: {kind}")
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in ids.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        by_bytes = {self.token_bytes[i]: i for i in ids.values()}
        for content, i in self.special.items():
            self.token_bytes[i] = content.encode()
        self.by_bytes = by_bytes

        # (left, right) -> (rank, token), and for each token how it was merged.
        self.rank = [-1] * size
        self.parts = [(i, i) for i in range(size)]
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = ids[left], ids[right]
            made = by_bytes[self.token_bytes[a] + self.token_bytes[b]]
            self.merge[a, b] = made
            if self.rank[made] < 0:
                self.rank[made], self.parts[made] = rank, (a, b)
        self.prefix = self._prefixes(by_bytes, size)
        self.automaton = ahocorasick.Automaton()
        for raw, i in by_bytes.items():
            self.automaton.add_word(raw.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.sizes = [len(t) for t in self.token_bytes]
        self.lengths = np.array(self.sizes, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.flat = np.frombuffer(b"".join(self.token_bytes), np.uint8)
        self.rule = regex.compile(PIECE_RULE)
        self.stops = regex.compile("|".join(map(regex.escape, self.special))) \
            if self.special else None
        self.pieces = _Pieces(self)
        self.pairs: dict[int, bool] = {}

    @staticmethod
    def _prefixes(by_bytes: dict[bytes, int], size: int) -> list[int]:
        """For each token the longest token that is a proper prefix of it, or -1."""
        out = [-1] * size
        for raw, i in by_bytes.items():
            for n in range(len(raw) - 1, 0, -1):
                if raw[:n] in by_bytes:
                    out[i] = by_bytes[raw[:n]]
                    break
        return out

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens yields just these two tokens."""
        key = left * len(self.parts) + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._seam_holds(left, right)
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        """Undo merges from the latest back; no merge across the seam may come earlier.

        ``limit`` is the rank of the merge undone last on either side: a merge across the seam
        of two parts that both existed before it would have been taken instead. At equal rank
        the left side merges first, so an equal merge across the seam wins over one to its right
        but not over one to its left.
        """
        rank, parts, merge = self.rank, self.parts, self.merge
        limit = len(merge) * 2 + 2
        a, b = left, right
        while True:
            made = merge.get((a, b))
            if made is not None and rank[made] * 2 + 1 < limit:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit = ra * 2
                a = parts[a][1]
            else:
                limit = rb * 2 + 2
                b = parts[b][0]

    def encode_piece(self, raw: bytes) -> list[int]:
        """Tokens of one piece of text between split points."""
        whole = self.by_bytes.get(raw)
        if whole is not None:
            return [whole]
        n = len(raw)
        longest = [0] * n
        token_at = [-1] * n
        lengths = self.sizes
        for end, token in self.automaton.iter(raw.decode("latin-1")):
            size = lengths[token]
            start = end + 1 - size
            if size > longest[start]:
                longest[start], token_at[start] = size, token
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, token_at[0]
        while at < n:
            end = at + lengths[token]
            if alive[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                token = token_at[at] if at < n else -1
                continue
            token = self.prefix[token]
            if token < 0:
                # Nothing fits here: this position is a dead end, go on below the token before it.
                alive[at] = 0
                if not out:
                    raise ValueError("the vocabulary cannot spell this text")
                token = out.pop()
                at -= lengths[token]
        return out

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.stops is None or not any(s in text for s in self.special):
            return b"".join(map(self.pieces.__getitem__, self.rule.findall(text)))
        out, last = [], 0
        for m in self.stops.finditer(text):
            out += map(self.pieces.__getitem__, self.rule.findall(text[last:m.start()]))
            out.append(self.special[m.group()].to_bytes(4, "little"))
            last = m.end()
        out += map(self.pieces.__getitem__, self.rule.findall(text[last:]))
        return b"".join(out)

    def decode(self, packed: bytes) -> bytes:
        """The UTF-8 text of packed ids, bytes that are no UTF-8 replaced as usual."""
        ids = np.frombuffer(packed, "<u4").astype(np.int64)
        if not len(ids):
            return b""
        size = self.lengths[ids]
        total = int(size.sum())
        begin = np.cumsum(size) - size
        raw = self.flat[np.arange(total) + np.repeat(self.starts[ids] - begin, size)].tobytes()
        try:
            raw.decode("utf-8")
            return raw
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode("utf-8")


class _Pieces(dict):
    """Packed ids of pieces seen before; pieces of more than 64 characters are not kept."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        packed = np.array(self.codec.encode_piece(piece.encode("utf-8")), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = packed
        return packed


_CODECS: OrderedDict[str, Codec] = OrderedDict()


def codec_for(file_text: str) -> Codec:
    """The codec of a vocabulary file, kept by the worker across tasks."""
    key = hashlib.sha256(file_text.encode()).hexdigest()
    if key not in _CODECS:
        while len(_CODECS) >= 2:
            _CODECS.popitem(last=False)
        _CODECS[key] = Codec(file_text)
    return _CODECS[key]


@dataclass(frozen=True)
class BpeParams:
    vocabulary: str  # path of the vocabulary file on the driver
    with_ids: bool = False
    with_text: bool = False


ROWS = 256


def _code_batches(vocabulary, params: BpeParams):
    def run(batches):
        codec = codec_for(vocabulary.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                n, ids, decoded, packs, texts = [], [], [], [], []
                for text in part.column(1).to_pylist():
                    packed = codec.encode(text or "")
                    back = codec.decode(packed)
                    n.append(len(packed) // 4)
                    ids.append(hashlib.sha256(packed).hexdigest())
                    decoded.append(hashlib.sha256(back).hexdigest())
                    if params.with_ids:
                        packs.append(np.frombuffer(packed, "<u4").astype(np.int32))
                    if params.with_text:
                        texts.append(back.decode("utf-8"))
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                           pa.array(decoded, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if params.with_ids:
                    columns.append(pa.array(packs, pa.list_(pa.int32())))
                    names.append("ids")
                if params.with_text:
                    columns.append(pa.array(texts, pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def encode_documents(docs: DataFrame, params: BpeParams) -> DataFrame:
    """Encode and decode every row of ``docs(doc_id, text)``.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids`` (array of
    int) and ``decoded``. Special strings inside a text become their special token, as the
    library does by default. The vocabulary file, of fixed size, is read on the driver and sent
    to the workers.

    Null or empty text: no tokens, the digests of nothing. Null doc_id: returned as such.
    Repeated rows are returned each. An empty table gives an empty result; extra columns are
    ignored.
    """
    spark = docs.sparkSession
    ship_code(spark)
    with open(params.vocabulary, encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * params.with_ids + ", decoded string" * params.with_text
    return only(docs, doc_id="long", text="string").mapInArrow(
        _code_batches(vocabulary, params), schema)
