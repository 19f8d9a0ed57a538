"""Sequence packing by power-of-two decomposition.

A document's tokens end with the end token. They are cut into pieces of ``max_len`` tokens,
then of the powers of two in the binary form of the rest, largest first. Every piece is a
sequence by itself: its length is a power of two, so sequences of one length form full
batches without padding and no sequence holds tokens of two documents. Nothing is
shuffled; ``write_buckets`` lays the pieces out by length.

Token ids come from the tokenizer file at ``tokenizer``. A text is split at single
spaces between words, where the vocabulary's pre-tokenizer always splits too, and the
ids of each distinct stretch are looked up in a bounded cache; texts with other spacing
round such a place, or with the name of a special token, are encoded in one go. With a
byte-level pre-tokenizer they are split round single line ends and between a letter and the
sign after it too, so that a word is encoded once whatever follows. All ways give the same ids.

Edge cases: NULL and empty texts are the end token alone (one piece of length 1); texts of
any length are cut into as many pieces as needed; repeated rows and NULL ids give pieces of their
own (``sequence_id`` is by row, not by id); other columns are ignored; an empty table
gives no pieces.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from replyloom.llm.common import give_back, per_batch, two_columns

MAX_LEN = 1024
END_ID = 0
CACHE_BYTES = 64 << 20
PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"
_NAMES = ("\0", "<|endoftext|>")
_JOIN = 256
_cache: dict = {}
# what the byte-level pre-tokenizer takes as one: a word of letters with the space before it, or signs
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_PIECE = re.compile(rf" ?[{_LETTER}]+|[!-&(-/:-@\[-`{{-~]+")
_WORD_END = f"([{_LETTER}])([.,;:!?])"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # ids of a stretch; None for one that spacing round it could change
        self.known: dict[str, bytes | None] = {}
        self.size = 0

        # the zero byte has an id of its own that takes part in no merge: it parts the stretches of one call
        vocab = self.tokenizer.get_vocab()
        zero = [i for t, i in vocab.items() if "\u0100" in t]
        self.zero = zero[0] if len(zero) == 1 else None
        self.words = self._for_pieces(path) if self.zero is not None else None

    def _for_pieces(self, path: str):
        """A tokenizer for pieces that need no pre-tokenizer, if the file's one cuts as ``_PIECE`` does."""
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        cuts = told["pre_tokenizer"] or {}
        if told["normalizer"] or told["model"]["type"] != "BPE" or (cuts.get("type"), cuts.get("use_regex", True), cuts.get("add_prefix_space")) != ("ByteLevel", True, False):
            return None
        words = Tokenizer(self.tokenizer.model)
        words.pre_tokenizer = pre_tokenizers.Split("\u0100", "isolated")
        # bytes as the vocabulary writes them
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {b: chr(b) for b in seen} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in seen)}
        return words

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parted(self, tokenizer, new: list[str], texts: list[str]) -> None:
        """Ids of new stretches, many to a call: ``texts`` are ``_JOIN`` of them, each ended by the zero byte."""
        groups = [new[i : i + _JOIN] for i in range(0, len(new), _JOIN)]
        for group, e in zip(groups, tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(ids == self.zero).tolist()
            data, at = ids.tobytes(), 0
            for p, end in zip(group, ends, strict=True):
                self.known[p] = data[4 * at : 4 * end]
                at = end + 1

    def _learn(self, new: list[str]) -> None:
        if self.zero is None:
            self.known.update(zip(new, self._encode(new), strict=True))
            return
        joined = lambda some: ["\0".join(some[i : i + _JOIN]) + "\0" for i in range(0, len(some), _JOIN)]
        if self.words:
            pieces = list(filter(_PIECE.fullmatch, new))
            new = [p for p in new if not _PIECE.fullmatch(p)]
            self._parted(self.words, pieces, [t.encode().decode("latin-1").translate(self.letters) for t in joined(pieces)])
        self._parted(self.tokenizer, new, joined(new))

    def _stretches(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Where each text begins among all stretches, the distinct ones, and which of them each is."""
        cut = pc.replace_substring(pa.array(texts, pa.large_string()), " ", "\0 ")
        if self.words:
            cut = pc.replace_substring(pc.replace_substring_regex(cut, _WORD_END, "\\1\0\\2"), "\n", "\0\n\0")
        parts = pc.split_pattern(cut, "\0")
        met = parts.flatten().dictionary_encode()
        return parts.offsets.to_numpy(), met.dictionary.to_numpy(zero_copy_only=False).tolist(), met.indices.to_numpy()

    def batch(self, texts: list[str | None]) -> list[bytes]:
        out: list = [b""] * len(texts)
        whole, cuts = [], []
        for i, t in enumerate(texts):
            if t:
                if t[0] in " '" or any(name in t for name in _NAMES):
                    whole.append(i)
                else:
                    cuts.append(i)
        if self.size > CACHE_BYTES:
            self.known, self.size = {}, 0
        if cuts:
            first, stretches, at = self._stretches([texts[i] for i in cuts])
            known = self.known
            if "\n" not in known and self.words:
                known["\n"] = self._encode(["\n"])[0]
            new = [p for p in stretches if p not in known]
            # white space next to a cut belongs to it; what follows an apostrophe there can be a word by itself
            plain = [p for p in new if (bare := p.removeprefix(" ")) and bare == bare.strip() and p[0] != "'"]
            known.update(dict.fromkeys(new))
            self._learn(plain)
            self.size += sum(map(len, new)) + 150 * len(new)
            # ids of all stretches one after the other, and for each place in a text where its are
            found = [known[p] for p in stretches]
            odd = np.array([x is None for x in found])
            length = np.array([0 if x is None else len(x) // 4 for x in found])
            ids = np.frombuffer(b"".join([x for x in found if x is not None]), "<u4")
            size = length[at]
            before = np.concatenate(([0], np.cumsum(size)))
            place = np.repeat((np.cumsum(length) - length)[at] - before[:-1], size) + np.arange(before[-1])
            data, ends = ids[place].tobytes(), (4 * before[first]).tolist()
            unsure = odd[at]
            # nothing after a line end is the end of the text
            ended = first[1:] - 1
            ended = ended[(ended > first[:-1]) & (at[ended] == (stretches.index("") if "" in stretches else -1))]
            unsure[ended] = False
            unsure = np.add.reduceat(unsure.astype(np.int64), first[:-1]).tolist()
            for n, i in enumerate(cuts):
                if unsure[n]:
                    whole.append(i)
                else:
                    out[i] = data[ends[n] : ends[n + 1]]
        for i, ids in zip(whole, self._encode([texts[i] for i in whole]), strict=True):
            out[i] = ids
        return out


def encoder(path: str) -> Encoder:
    if path not in _cache:
        _cache[path] = Encoder(path)
        # reading the file leaves several times what is kept
        give_back()
    return _cache[path]


def decompose(n: int, max_len: int = MAX_LEN) -> list[int]:
    """Piece lengths of ``n`` tokens: whole sequences, then the powers of two of the rest."""
    rest = n % max_len
    return [max_len] * (n // max_len) + [1 << b for b in range(max_len.bit_length() - 2, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str | None = None, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """A row for each piece: doc_id, start, length, doc_tokens, ids (little-endian unsigned
    32-bit), sequence_id, offset. ``max_len`` is a power of two."""
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, starts, lengths, totals, data = [], [], [], [], []
        for doc, got in zip(batch.column("doc_id").to_pylist(), encoder(path).batch(batch.column("text").to_pylist()), strict=True):
            got += end
            total, at = len(got) // 4, 0
            for n in decompose(total, max_len):
                ids.append(doc), starts.append(at), lengths.append(n), totals.append(total), data.append(got[4 * at : 4 * (at + n)])
                at += n
        longs = [pa.array(x, pa.int64()) for x in (ids, starts, lengths, totals)]
        return pa.RecordBatch.from_arrays([*longs, pa.array(data, pa.binary())], names=["doc_id", "start", "length", "doc_tokens", "ids"])

    pieces = two_columns(docs).mapInArrow(per_batch(run, 1 << 20), PIECES)
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("bigint"))


def write_buckets(pieces: DataFrame, path: str, spread: int = 64) -> None:
    """Pieces by length: one folder a length, each over at most ``spread`` files."""
    pieces.repartition("length", F.pmod("sequence_id", F.lit(spread))).write.partitionBy("length").parquet(path)
