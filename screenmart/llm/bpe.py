"""Byte-level BPE by longest matches and compatible neighbours, in linear time."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenmart.llm.common import cuts, documents, kept, map_column
from screenmart.llm.pieces import Encoded

#: Pair verdicts that a worker remembers before it starts afresh.
PAIRS = 150_000
#: Pieces that a worker remembers, some 100 bytes each; an executor has a worker for each core, which encodes and decodes.
PIECES = 300_000


class Irregular(Exception):
    """Merges are not in order of rank, so pairs alone do not decide: plain merging does. Trained vocabularies have none."""


class Bpe:
    """Tokens by rank: of two neighbouring parts whose bytes together are a token, the lowest rank merges first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.matches = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for token, rank in ranks.items():
            self.matches.add_word(token.decode("latin-1"), rank)
        self.matches.make_automaton()
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(self.length.values())
        self.made: dict[int, bool] = {}
        #: Tokens that a merge of lower rank follows one of higher rank in: ranks then do not tell what came first.
        self.irregular: set[int] = set()
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.shorter: dict[int, int | None] = {}
        self.fits: dict[tuple[int, int], bool] = {}

    def merge(self, piece: bytes) -> tuple[list[int], tuple[int, int] | None, bool]:
        """Plain merging: the ids, the two parts of the last merge, and whether ranks only rose."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        last, before, rising = None, -1, True
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            known = [r for r in ranks if r is not None]
            if not known:
                break
            rank = min(known)
            at = ranks.index(rank)
            last = (self.ranks[parts[at]], self.ranks[parts[at + 1]])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            rising, before = rising and rank >= before, rank
        return [self.ranks[p] for p in parts], last, rising

    def split(self, token: int) -> tuple[int, int] | None:
        """The parts that a token is merged from; None for a single byte."""
        if token not in self.parts:
            self.parts[token] = self.merge(self.bytes_of[token])[1]
        return self.parts[token]

    def reachable(self, token: int) -> bool:
        known = self.made.get(token)
        if known is None:
            ids, _, rising = self.merge(self.bytes_of[token])
            known = self.made[token] = ids == [token]
            if known and not rising:
                self.irregular.add(token)
        return known

    def next_shorter(self, token: int) -> int | None:
        """The longest reachable token that is a proper prefix."""
        if token not in self.shorter:
            text = self.bytes_of[token]
            found = (self.ranks.get(text[:n]) for n in range(len(text) - 1, 0, -1))
            self.shorter[token] = next((t for t in found if t is not None and self.reachable(t)), None)
        return self.shorter[token]

    def compatible(self, pair: tuple[int, int]) -> bool:
        """Whether merging ever leaves the two tokens side by side; the answer is remembered."""
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        verdict = self.reachable(pair[0]) and self.reachable(pair[1])
        if verdict and not self.irregular.isdisjoint(pair):
            raise Irregular
        verdict = verdict and self._stay_apart(*pair)
        self.fits[pair] = verdict
        return verdict

    def _stay_apart(self, left: int, right: int) -> bool:
        """No merge across the border comes before those that made the two.

        Undoes the merges on both sides of the border, the latest first, and looks at each
        pair of parts that once stood beside it.
        """
        # Steps of each side from the bytes up: (rank at which the part at the border appears, part).
        lefts, rights = [left], [right]
        while (parts := self.split(lefts[-1])) is not None:
            lefts.append(parts[1])
        while (parts := self.split(rights[-1])) is not None:
            rights.append(parts[0])
        i, j = len(lefts) - 1, len(rights) - 1
        while True:
            # The next merge that changes the border from inside; equal ranks merge from the left.
            next_left = lefts[i - 1] if i else None
            next_right = rights[j - 1] if j else None
            across = self.ranks.get(self.bytes_of[lefts[i]] + self.bytes_of[rights[j]])
            if across is not None:
                beats_left = next_left is None or across < next_left
                beats_right = next_right is None or across <= next_right
                if beats_left and beats_right:
                    return False
            if next_left is None and next_right is None:
                return True
            if next_right is None or (next_left is not None and next_left <= next_right):
                i -= 1
            else:
                j -= 1

    def encode(self, piece: bytes) -> list[int]:
        """The ids that merging gives. A piece that is a token is that token.

        Takes the longest match at each position. At the first pair that cannot stand side by side it
        tries shorter matches, then gives up the token before; a position that led nowhere is not
        entered again, so the work is linear in the piece.
        """
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        try:
            return self._match(piece)
        except Irregular:
            return self.merge(piece)[0]

    def _match(self, piece: bytes) -> list[int]:
        fits, compatible = self.fits, self.compatible
        text = piece.decode("latin-1")
        ids = [token for _, token in self.matches.iter_long(text)]
        good = 1
        for pair in zip(ids, ids[1:], strict=False):
            fit = fits.get(pair)
            if not (compatible(pair) if fit is None else fit):
                break
            good += 1
        else:
            return ids
        token = ids[good]
        del ids[good:]
        length, shorter = self.length, self.shorter
        at, n = sum(length[t] for t in ids), len(piece)
        dead = set()
        while True:
            end = at + length[token]
            if end not in dead:
                if not ids:
                    fit = True
                elif (fit := fits.get((ids[-1], token))) is None:
                    fit = compatible((ids[-1], token))
                if fit:
                    ids.append(token)
                    if end == n:
                        return ids
                    at = end
                    # Only the part that a token can cover: the call costs time in the length of what it is given.
                    token = next(self.matches.iter_long(text[at : at + self.longest]))[1]
                    continue
            token = shorter[token] if token in shorter else self.next_shorter(token)
            while token is None:
                if not ids:
                    raise Irregular
                dead.add(at)
                token = ids.pop()
                at -= length[token]
                token = self.next_shorter(token)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _loaded(path: str) -> tuple[Bpe, Encoded]:
    return kept(("ranks", path), lambda: _load(path))


def _load(path: str) -> tuple[Bpe, Encoded]:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    bpe = Bpe(ranks)
    return bpe, Encoded(lambda pieces: [bpe.encode(p.encode("utf-8", "surrogatepass")) for p in pieces], most=PIECES)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def encode(docs: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """All columns of ``docs`` with the token ids of the whole text; a null text is empty and has none.

    ``path`` names the rank file on every executor. Pieces are those of the pattern that
    belongs to the file. Each worker keeps the ids of pieces it has met.
    """

    def run(texts: pa.Array) -> pa.Array:
        _, encoded = _loaded(path)
        lists = [pa.array([], pa.list_(pa.int32()))]
        for begin, end in cuts(pc.binary_length(texts).fill_null(0).to_pylist()):
            ids, sizes = encoded.texts([t or "" for t in texts.slice(begin, end - begin).to_pylist()])
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)))
        return pa.concat_arrays(lists)

    ids = map_column(F.col("text"), run, T.ArrayType(T.IntegerType()), docs.sparkSession)
    return docs.drop(column).select("*", ids.alias(column))


#: What ``digests`` tells of a list of ids.
DIGESTS = T.StructType(
    [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
)


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the id lists in column ``ids``, decoded anew."""

    def run(lists: pa.Array) -> pa.Array:
        bpe, _ = _loaded(path)
        sha = hashlib.sha256

        def digest(found: pa.ListScalar) -> tuple[int, str, str]:
            ids = np.asarray(found.values).tolist() if found.is_valid else []
            return len(ids), sha(",".join(map(str, ids)).encode()).hexdigest(), sha(bpe.decode(ids)).hexdigest()

        rows = [digest(found) for found in lists]  # one text's ids unpacked at a time
        columns = [pa.array([row[k] for row in rows], type_) for k, type_ in enumerate((pa.int64(), pa.string(), pa.string()))]
        return pa.StructArray.from_arrays(columns, DIGESTS.names)

    found = map_column(F.col("ids"), run, DIGESTS, encoded.sparkSession)
    return encoded.select("doc_id", found.alias("found")).select("doc_id", "found.*")


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    path = default_ranks()
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return digests(encode(docs, path).select("doc_id", F.col("ids")), path)
