"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string the encoding has one last token, and that token is the only one which ends the prefix
and fits behind the last token of the prefix before it: two tokens fit if encoding their bytes together gives just these
two.  ``Prefixes`` stores that token for each prefix.  Bytes appended continue the table; an edit keeps the table up to
the edit and computes the rest; reading the table backwards from any prefix gives that prefix's encoding.

Texts are first split by the tokenizer's pattern, whose matches are encoded separately.  A space between two characters
that are not white space always starts a match, so texts are cut there and each cut piece is encoded once and remembered
(the memory is bounded).  ``Document`` keeps a text's pieces, for appends and edits that encode only the pieces they touch.

Defined results: a null text is an empty one; an empty text has no ids; a text is encoded whole whatever its length; rows
that share a doc_id, and a null doc_id, keep their rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescan.llm.common import ship, texts

MEMORY = 400_000
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# fixed value: the public pattern of this vocabulary family
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, of a file with a base64 token and its rank in each line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Vocabulary:
    """Tokens with their ranks, and what tells whether two tokens can be neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values(), default=-1) + 1
        self.bytes_of = [b""] * self.size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.length = list(map(len, self.bytes_of))
        # a state is the longest end of what was read that begins a token; found as needed
        self._begins = {token[:k] for token in ranks for k in range(1, len(token) + 1)}
        self._state_of: dict[bytes, int] = {b"": 0}
        self._states = [b""]
        self.steps: dict[int, int] = {}
        #: by state, the tokens that end there, longest first, with their lengths
        self.ends: list[tuple[tuple[int, int], ...]] = [()]
        self.known_fits: dict[int, bool] = {}
        self._grown: dict[int, tuple[bool, list, list]] = {}

    def step(self, state: int, byte: int) -> int:
        """The state after one more byte."""
        key = state << 8 | byte
        found = self.steps.get(key)
        if found is None:
            text = self._states[state] + bytes((byte,))
            while text and text not in self._begins:
                text = text[1:]
            found = self._state_of.get(text)
            if found is None:
                found = self._state_of[text] = len(self._states)
                self._states.append(text)
                self.ends.append(tuple((self.ranks[text[k:]], len(text) - k) for k in range(len(text)) if text[k:] in self.ranks))
            self.steps[key] = found
        return found

    def merged(self, data: bytes, watch: list | None = None) -> list[int]:
        """The definition: merge the neighbours of lowest rank, leftmost first, until none merge.  For short strings.

        ``watch`` gets the rank of each merge and the outermost parts after it.
        """
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[k] + parts[k + 1], self.size), k) for k in range(len(parts) - 1))
            if rank == self.size:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if watch is not None:
                watch.append((rank, parts[0], parts[-1]))
        return [self.ranks[p] for p in parts]

    def grown(self, token: int) -> tuple[bool, list, list]:
        """Whether the token's bytes are encoded as this token, and how its first and its last part grow: (bytes, rank of
        the merge that ends them) in order of time."""
        known = self._grown.get(token)
        if known is None:
            data, seen = self.bytes_of[token], []
            alone = self.merged(data, seen) == [token]
            first, last = [], []
            f, g = data[:1], data[-1:]
            for rank, a, b in seen:
                if a != f:
                    first.append((f, rank))
                    f = a
                if b != g:
                    last.append((g, rank))
                    g = b
            known = self._grown[token] = alone, [*first, (f, self.size)], [*last, (g, self.size)]
        return known

    def alone(self, token: int) -> bool:
        return self.grown(token)[0]

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left``: while both grow, no merge across the seam comes before theirs."""
        key = left * self.size + right
        known = self.known_fits.get(key)
        if known is None:
            if len(self.known_fits) >= 2 * MEMORY:
                self.known_fits.clear()
            known = self.known_fits[key] = self._seam_holds(left, right)
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        ok_l, _, ends = self.grown(left)
        ok_r, starts, _ = self.grown(right)
        if not (ok_l and ok_r):
            return False
        ranks, none, i, j = self.ranks, self.size, 0, 0
        while True:
            (a, until_a), (b, until_b) = ends[i], starts[j]
            across = ranks.get(a + b, none)
            # of equal ranks the leftmost merges first: the left part's, then across, then the right part's
            if across < until_a and across <= until_b and across < none:
                return False
            if until_a == until_b == none:
                return True
            if until_a <= until_b:
                i += 1
            else:
                j += 1


class Prefixes:
    """The last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last, self._at = vocabulary, b"", [], [0]
        self.append(data)

    def append(self, more: bytes) -> None:
        v, last, at, end = self.vocabulary, self.last, self._at, len(self.data)
        steps, ends, size, known, state = v.steps.get, v.ends, v.size, v.known_fits.get, at[-1]
        for byte in more:
            state = steps(state << 8 | byte) or v.step(state, byte)
            at.append(state)
            end += 1
            for token, n in ends[state]:
                if n == end:
                    ok = v.alone(token)
                else:
                    left = last[end - n - 1]
                    ok = known(left * size + token)
                    if ok is None:
                        ok = v.fits(left, token)
                if ok:
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
        self.data += more

    def edit(self, start: int, end: int, new: bytes) -> None:
        """Puts ``new`` in place of the bytes from start to end; the table of the bytes before stays."""
        new += self.data[end:]
        self.data = self.data[:start]
        del self.last[start:], self._at[start + 1 :]
        self.append(new)

    def ids(self, upto: int | None = None) -> list[int]:
        """The encoding of the first ``upto`` bytes."""
        at, out, last, length = len(self.data) if upto is None else upto, [], self.last, self.vocabulary.length
        while at:
            token = last[at - 1]
            out.append(token)
            at -= length[token]
        out.reverse()
        return out


def cut_points(text: str) -> list[str]:
    """``text`` in pieces that are encoded separately: cut before each single space between characters that are not white space."""
    raw = text.split(" ")
    if len(raw) == 1:
        return [text] if text else []
    out, loose = [], ""  # loose: what cannot be cut from the piece that follows
    before_ok = False
    for k, part in enumerate(raw):
        piece = part if k == 0 else " " + part
        if k and before_ok and part and not part[0].isspace():
            out.append(loose)
            loose = piece
        else:
            loose += piece
        before_ok = bool(part) and not part[-1].isspace()
    if loose:
        out.append(loose)
    return out


class Memory:
    """Values of short strings, a bounded number of them: the latest, and those used again of the ones before."""

    def __init__(self, limit: int = MEMORY):
        self.limit, self.now, self.before = limit, {}, {}

    def turn(self) -> None:
        """Makes room; to be called between uses."""
        if len(self.now) >= self.limit:
            self.before, self.now = self.now, {}

    def unknown(self, keys: set[str]) -> set[str]:
        """What of ``keys`` has no value yet; the others are among the latest afterwards."""
        now, before, out = self.now, self.before, set()
        for key in keys:
            if key not in now:
                if key in before:
                    now[key] = before[key]
                else:
                    out.add(key)
        return out


class Encoder:
    """Encodes texts.  What stands between two spaces is remembered with the space before it."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.words_whole = pattern == WORD_PATTERN
        self.memory = Memory()
        self.digits = [str(k) for k in range(vocabulary.size)]

    def match_ids(self, match: str) -> list[int]:
        data = match.encode("utf-8", "surrogatepass")
        whole = self.vocabulary.ranks.get(data)
        return [whole] if whole is not None else Prefixes(self.vocabulary, data).ids()

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.match_ids, self.pattern.findall(piece))))

    def learn(self, rests: set[str]) -> None:
        """Remembers what follows a space and has no white space at its ends.  Words are taken in order, and each keeps
        the table of the prefix that it shares with the one before."""
        memory, tails, words = self.memory, {}, {}
        for rest in memory.unknown(rests):
            if not rest or rest[0].isspace() or rest[-1].isspace():
                continue
            word = rest if rest.isalpha() else rest.rstrip(SIGNS)
            if self.words_whole and word.isalpha():  # letters, then signs: two matches
                words.setdefault((" " + word).encode("utf-8", "surrogatepass"), []).append((rest, rest[len(word) :]))
            else:
                memory.now[rest] = self.piece_ids(" " + rest)
        table, ranks = Prefixes(self.vocabulary), self.vocabulary.ranks
        for data in sorted(words):
            whole = ranks.get(data)
            if whole is None:
                same, old = 0, table.data
                for a, b in zip(data, old):
                    if a != b:
                        break
                    same += 1
                table.edit(same, len(old), data[same:])
                ids = tuple(table.ids())
            else:
                ids = (whole,)
            for rest, tail in words[data]:
                if tail and tail not in tails:
                    tails[tail] = self.piece_ids(tail)
                memory.now[rest] = ids + tails[tail] if tail else ids

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text."""
        self.memory.turn()
        split = [text.split(" ") for text in texts]
        self.learn(set(chain.from_iterable(parts[1:] for parts in split)))
        known = self.memory.now.__getitem__
        for text, (first, *rest) in zip(texts, split):
            try:
                if rest and (not first or first[-1].isspace()):
                    raise KeyError
                out = list(self.piece_ids(first))
                out.extend(chain.from_iterable(map(known, rest)))
            except KeyError:  # spaces beside white space or at an end: cut elsewhere
                out = list(chain.from_iterable(map(self.piece_ids, cut_points(text))))
            yield out

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))


class Document:
    """A text with its encoding, for appends and edits."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder = encoder
        self.parts = cut_points(text)

    @property
    def text(self) -> str:
        return "".join(self.parts)

    def ids(self) -> list[int]:
        return list(chain.from_iterable(map(self.encoder.piece_ids, self.parts)))

    def append(self, more: str) -> None:
        tail = self.parts.pop() if self.parts else ""
        self.parts += cut_points(tail + more)

    def edit(self, start: int, end: int, new: str) -> None:
        """Puts ``new`` in place of the characters from start to end; pieces away from the edit stay as they are."""
        at, first, lo = 0, None, 0
        last, hi = len(self.parts), len(self.text)
        for k, part in enumerate(self.parts):
            stop = at + len(part)
            if first is None and stop >= start:
                first, lo = k, at
            if first is not None and at > end:
                last, hi = k, at
                break
            at = stop
        first = len(self.parts) if first is None else first
        while last < len(self.parts) and last - first < 1:
            last += 1
        middle = "".join(self.parts[first:last])
        hi = lo + len(middle)
        if first:  # a cut depends on the character before it
            first -= 1
            lo -= len(self.parts[first])
        if last < len(self.parts):
            hi += len(self.parts[last])
            last += 1
        middle = "".join(self.parts[first:last])
        self.parts[first:last] = cut_points(middle[: start - lo] + new + middle[end - lo :])


_encoders: dict[bytes, Encoder] = {}


def encoder_of(data: bytes, pattern: str) -> Encoder:
    """One encoder a worker process and vocabulary, so that its memory serves all its tasks."""
    key = hashlib.sha1(data + pattern.encode()).digest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Vocabulary(read_ranks(data)), pattern)
    return _encoders[key]


def default_vocabulary() -> tuple[str, str]:
    """Path of the rank file and the pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>, left out without ``with_ids``), ids_sha256 of the ids in decimals joined by
    commas, decoded_sha256 of the bytes that the ids decode to, of each row of ``docs`` (doc_id, text).

    The vocabulary (under 2 MB) is read by the driver and sent to the executors.
    """
    spark = docs.sparkSession
    ship(spark)
    own_path, own_pattern = default_vocabulary() if path is None or pattern is None else (path, pattern)
    path, pattern = path or own_path, pattern or own_pattern
    with open(path, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(data.value, pattern)
        digits = encoder.digits
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                n, a, b, all_ids = [], [], [], []
                for ids in encoder.encode_all(texts(batch)):
                    n.append(len(ids))
                    a.append(hashlib.sha256(",".join(map(digits.__getitem__, ids)).encode()).hexdigest())
                    b.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                    if with_ids:
                        all_ids.append(ids)
                columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64())}
                if with_ids:
                    columns["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
                columns |= {"ids_sha256": pa.array(a, pa.string()), "decoded_sha256": pa.array(b, pa.string())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = "doc_id long, n_tokens long, " + "ids array<int>, " * with_ids + "ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(walk, schema)
