"""SentencePiece encoding and decoding, for merge-type (BPE) models.

Encoding is exact and does not merge: a text is cut where no piece can reach over, and each unit is covered from left to
right by the longest match of an Aho-Corasick automaton. Two neighbours are allowed if merging their joint text again
gives the same two pieces; if no match fits, the last piece is shortened, and positions from which no covering exists are
marked in a bitfield, so each is left once. Pieces of blanks only have the lowest score, all the same one; runs of blanks
are therefore what is left after all other merges, and are merged by a rule of their own.

Cases: a null text is empty and has no ids. Equal rows are encoded alike. Text of any length is encoded whole, unit by unit.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slotwise.llm.common import with_made

BLANK = "▁"
#: Units, and pairs of pieces, that a worker remembers, and as many from before; the least recent half goes.
MEMORY = 200_000
#: Pieces by kind, in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = range(4)


class Vocabulary:
    """Pieces of a model file, read on the driver and sent to the tasks (about 0.5 MB)."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        kind = lambda i: BYTE if model.is_byte(i) else CONTROL if model.is_control(i) else UNKNOWN if model.is_unknown(i) else NORMAL
        self.pieces, self.scores, self.kinds = [model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], [kind(i) for i in ids]
        if BYTE not in self.kinds or any(BLANK in p.lstrip(BLANK) for p in self.pieces):
            raise ValueError("a model with byte pieces and with blanks only at the start of pieces is needed")
        if model.encode("a  b ", out_type=str)[0][0] != BLANK or model.normalize("A  ﬁ") != f"{BLANK}A {BLANK}ﬁ":
            raise ValueError("a model without normalisation, with a blank put first, is needed")
        self.key = hashlib.sha256(repr((self.pieces, self.scores, self.kinds)).encode()).hexdigest()


class Remembered(dict):
    def __init__(self, make: Callable):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        if len(self) >= MEMORY:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        self[key] = value = self.make(key) if value is None else value
        return value


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        v = self.vocabulary = vocabulary
        self.id = {p: i for i, p in enumerate(v.pieces) if v.kinds[i] == NORMAL}
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(v.pieces) if v.kinds[i] == BYTE}
        self.blanks = {len(p): i for p, i in self.id.items() if len(p) > 1 and not p.strip(BLANK)}
        normal = {p: i for p, i in self.id.items() if i not in self.blanks.values()}
        if self.blanks and max(v.scores[i] for i in self.blanks.values()) >= min(v.scores[i] for p, i in normal.items() if len(p) > 1):
            raise ValueError("runs of blanks must be the last to merge")
        self.score = {p: v.scores[i] for p, i in normal.items()}
        self.unit = self.unit_pattern(normal)
        self.matches = ahocorasick.Automaton()
        built = {p: self.merge(p, 2) for p in normal}
        reached = {p: normal[p] for p, parts in built.items() if len(p) == 1 or len(parts) == 2 and all(x in normal for x in parts)}
        for p, i in reached.items():
            self.matches.add_word(p, (i, len(p)))
        self.matches.make_automaton()
        self.length = {i: len(p) for p, i in reached.items()}
        self.shorter = {i: next((reached[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in reached), None) for p, i in reached.items()}
        order = {p: k for k, p in enumerate(sorted(reached, key=lambda p: -v.scores[reached[p]]))}
        self.made = {i: order[p] if len(p) > 1 else -1 for p, i in reached.items()}
        self.halves = {i: tuple(reached[x] for x in built[p]) for p, i in reached.items() if len(p) > 1}
        cuts = ((p, reached.get(p[:n]), reached.get(p[n:])) for p in reached for n in range(1, len(p)))
        self.joint = {(a, b): order[p] for p, a, b in cuts if a is not None and b is not None}
        self.known = {p for p in self.id if len(p) == 1}
        self.pairs = Remembered(lambda pair: self.fits(*pair))
        self.units = Remembered(self.encode_unit)
        self.decimal = [str(i) for i in range(len(v.pieces))]
        self.raw = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.replace(BLANK, " ").encode() for p, k in zip(v.pieces, v.kinds)]

    @staticmethod
    def unit_pattern(pieces: dict) -> re.Pattern:
        """A unit starts at a blank, at a line feed, and at a stop or comma after a character that no piece has before it."""
        before = {x: "".join(re.escape(p[k - 1]) for p in pieces for k in range(1, len(p)) if p[k] == x) for x in ".,"}
        inner = "|".join(f"(?<=[{re.escape(x)}{chars}]){re.escape(x)}" for x, chars in before.items())
        return re.compile(f"\n|(?:{BLANK}+|[.,])(?:[^{BLANK}\n.,]+|{inner})*|(?:[^{BLANK}\n.,]+|{inner})+")

    def merge(self, text: str, until: int = 1) -> list[str]:
        """Merge neighbours, best score first and then leftmost, until so many parts are left; for short texts."""
        parts, score = list(text), self.score
        while len(parts) > until:
            best = max(((score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score), default=None)
            if best is None:
                break
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the joint text of two pieces gives them again.

        Their last merges are undone, the later one first. The parts at the seam would have merged instead if their
        joint piece comes before the merge undone last; of equal merges, the left one comes first.
        """
        joint, made, halves, undone = self.joint, self.made, self.halves, float("inf")
        while True:
            if joint.get((a, b), undone) < undone:
                return False
            left, right = made[a], made[b]
            if left > right:
                undone, a = left, halves[a][1]
            elif right < 0:
                return True
            else:
                undone, b = right + 0.5, halves[b][0]

    def cover(self, text: str) -> list[int]:
        """The pieces of a text whose characters are all pieces."""
        longest = [None] * (len(text) + 1)
        for end, (i, n) in self.matches.iter(text):
            longest[end - n + 1] = i
        length, shorter, fits = self.length, self.shorter, self.pairs
        failed, found, at, piece = bytearray(len(text) + 1), [], 0, longest[0]
        while piece is not None:
            last = found[-1] if found else None
            while piece is not None and (failed[at + length[piece]] or last is not None and not fits[last, piece]):
                piece = shorter[piece]
            if piece is None:
                failed[at] = 1
                at -= length[last]
                piece = found.pop()
            else:
                found.append(piece)
                at += length[piece]
                piece = longest[at]
        return found

    def encode_blanks(self, n: int) -> list[int]:
        """n blanks that are left over: equal scores, so the leftmost run grows while its sum is a piece."""
        sizes, top = [1] * (n % max(self.blanks, default=1) if self.blanks else n), max(self.blanks, default=1)
        while (k := next((k for k in range(len(sizes) - 1) if sizes[k] + sizes[k + 1] in self.blanks), None)) is not None:
            sizes[k : k + 2] = [sizes[k] + sizes[k + 1]]
        return [self.blanks[top]] * (n // top if self.blanks else 0) + [self.blanks[k] if k > 1 else self.id[BLANK] for k in sizes]

    def encode_unit(self, unit: str) -> tuple[int, ...]:
        word = unit.lstrip(BLANK)
        blanks = len(unit) - len(word)
        ids: list[int] = []
        text = (BLANK if blanks else "") + word if word else ""
        if self.known.issuperset(text):
            ids = self.cover(text)
        else:
            for known, run in groupby(text, self.id.__contains__):
                ids += self.cover("".join(run)) if known else [self.byte[b] for c in run for b in c.encode()]
        if word and blanks:
            blanks -= 1
            if ids[0] == self.id[BLANK]:
                blanks += 1
                ids = ids[1:]
        return (*self.encode_blanks(blanks), *ids) if blanks else tuple(ids)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        return list(chain.from_iterable(map(self.units.__getitem__, self.unit.findall(BLANK + text.replace(" ", BLANK)))))

    def decode(self, ids: list[int]) -> str:
        """Bytes that are no UTF-8 become replacement characters, one each."""
        v = self.vocabulary
        first = next((k for k, i in enumerate(ids) if v.kinds[i] != CONTROL), None)
        if first is None:
            return ""
        strip = v.kinds[ids[first]] == NORMAL and v.pieces[ids[first]].startswith(BLANK)
        try:
            text = b"".join(map(self.raw.__getitem__, ids)).decode()
        except UnicodeDecodeError:
            runs = groupby(ids, lambda i: v.kinds[i] == BYTE)
            text = "".join(b"".join(self.raw[i] for i in run).decode(errors="each" if byte else "strict") for byte, run in runs)
        return text[1:] if strip else text

    def digest(self, text: str | None) -> tuple[int, str, str]:
        ids = self.encode(text)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return len(ids), sha(",".join(map(self.decimal.__getitem__, ids))), sha(self.decode(ids))


def one_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


@lru_cache(1)
def of_key(key: str, hold: tuple) -> Codec:
    return Codec(hold[0])


class Held(tuple):
    """Equal by the vocabulary's content, so that a worker builds each codec once."""

    def __hash__(self):
        return hash(self[0].key)

    def __eq__(self, other):
        return self[0].key == other[0].key


def codec(vocabulary: Vocabulary) -> Codec:
    import codecs

    codecs.register_error("each", one_each)
    return of_key(vocabulary.key, Held((vocabulary,)))


def default_vocabulary(path: str | None = None) -> Vocabulary:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return Vocabulary(path)


def _apply(docs: DataFrame, vocabulary: Vocabulary, read: str, made: pa.Schema, of: Callable) -> DataFrame:
    def worker():
        work = codec(vocabulary)
        return lambda x: of(work, x)

    return with_made(docs.select("doc_id", read), read, made, worker).drop(read)


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids."""
    made = pa.schema([("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
    return _apply(docs, vocabulary, "text", made, lambda c, t: (len(i := c.encode(t)), np.array(i, np.int32)))


def encode_and_check(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256 (of the text that the ids decode to)."""
    made = pa.schema([("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded_sha256", pa.string())])

    def of(c: Codec, text: str | None) -> tuple:
        ids = c.encode(text)
        return len(ids), np.array(ids, np.int32), hashlib.sha256(c.decode(ids).encode()).hexdigest()

    return _apply(docs, vocabulary, "text", made, of)


def decode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, text from doc_id, ids; null ids give a null text."""
    return _apply(rows, vocabulary, "ids", pa.schema([("text", pa.string())]), lambda c, i: (None if i is None else c.decode(i),))


def digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: of the ids, and of the text that they decode to."""
    made = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    return _apply(docs, vocabulary, "text", made, lambda c, t: c.digest(t))
