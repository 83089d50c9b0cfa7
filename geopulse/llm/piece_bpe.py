"""SentencePiece (merge type) encoding and decoding.

Encoding fills a table with the last token of the encoding of every prefix of a
text.  That token is unique: of all vocabulary pieces that end at a position
(found by an Aho-Corasick automaton) exactly one is compatible with the last
token of the prefix before it, where two tokens are compatible if encoding
their concatenation yields the two again.  The ids are then recovered from the
last position backwards.

No merge crosses a border between a character and the white-space mark that
follows it, nor one beside a character that occurs in no longer piece, so texts
are cut there and the encodings of the parts are remembered (a bounded cache).

Defined results: a null or empty text has the end id only (if asked for); null
keys, repeated rows and extra columns pass through; texts of any length work.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from geopulse.llm.common import FORGET

SPACE = "▁"
#: What a worker remembers, some 200 MB, until a task of another operator begins in it; then the model goes too.
_CACHE_UNITS = 200_000
_CACHE_PAIRS = 1_000_000
_LONG_UNIT = 256


class PieceModel:
    """Vocabulary of a SentencePiece BPE model with byte fallback and identity normaliser."""

    def __init__(self, path: str):
        source = sentencepiece.SentencePieceProcessor(model_file=path)
        if source.normalize(" 　ﬁ  x ") != f"{SPACE}{SPACE}　ﬁ{SPACE}{SPACE}x{SPACE}":
            raise ValueError("only models with the identity normaliser and a dummy prefix are supported")
        self.end, self.unknown = source.eos_id(), source.unk_id()
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_ids = [self.unknown] * 256
        self.surface: list[bytes] = []
        self.byte_of: dict[int, int] = {}
        for i in range(source.get_piece_size()):
            piece = source.id_to_piece(i)
            if source.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.byte_of[i] = i, value
                self.surface.append(bytes([value]))
            elif source.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            elif source.is_control(i):
                self.surface.append(b"")
            elif source.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            else:
                self.ids[piece], self.score[piece] = i, source.get_score(i)
                self.surface.append(piece.replace(SPACE, " ").encode())
        self.lengths = [len(source.id_to_piece(i)) for i in range(source.get_piece_size())]
        self.control = {i for i in range(source.get_piece_size()) if source.is_control(i)}
        self._build_automaton()
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces with inner white space are not supported")
        self.unit = self._unit_pattern()
        self.forget()

    def forget(self) -> None:
        """Drop all that encoding has remembered."""
        self.splits: dict[str, tuple[str, str] | None] = {}
        self.names = {i: piece for piece, i in self.ids.items()}
        self.lone: dict[str, int] = {}  # numbers of characters outside the vocabulary
        self.pairs: dict[int, bool] = {}
        self.units: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def _build_automaton(self) -> None:
        """Aho-Corasick automaton: steps and failure links by state, and the pieces that end
        in a state as (id, length), the longest first."""
        self.step: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for piece in self.ids:
            state = 0
            for c in piece:
                state = self.step[state].setdefault(c, len(self.step))
                if state == len(self.step):
                    self.step.append({})
                    self.ends.append([])
            self.ends[state] = [(self.ids[piece], len(piece))]
        self.fail = [0] * len(self.step)
        level = list(self.step[0].values())
        while level:
            below = []
            for state in level:
                for c, child in self.step[state].items():
                    self.fail[child] = self._follow(self.fail[state], c)
                    below.append(child)
                self.ends[state] = self.ends[state] + self.ends[self.fail[state]]
            level = below

    def _follow(self, state: int, c: str) -> int:
        while c not in self.step[state]:
            if not state:
                return 0
            state = self.fail[state]
        return self.step[state][c]

    def _unit_pattern(self) -> re.Pattern:
        """Parts that no merge leaves: cut before white space, around characters that occur
        in no longer piece, and between a letter or digit and a mark that follows none."""
        longer = [p.lstrip(SPACE) for p in self.ids if len(p) > 1]
        joined = set("".join(longer))
        letters = {c for c in joined if c.isalnum()}
        after = {p[i + 1] for p in longer for i in range(len(p) - 1) if p[i] in letters}
        marks = joined - letters - after
        every, rest, letter, mark = ("[" + "".join(map(re.escape, sorted(x))) + "]" if x else "(?!)"
                                     for x in (joined, joined - marks, letters, marks))
        return re.compile(f"{SPACE}*{every}{rest}*(?:(?<!{letter}){mark}+{rest}*)*|{SPACE}+|.", re.DOTALL)

    def _merge(self, text: str, trace: list | None = None) -> list[str]:
        """Encoding of a short text by the definition: best score first, leftmost on ties."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            if trace is not None:
                trace.append((parts[at], parts[at + 1]))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _split(self, token: str) -> tuple[str, str] | None:
        """The two tokens that the last merge of ``token`` joined; None if its merges
        don't run from better to worse scores, or if it does not encode as itself."""
        if token not in self.splits:
            trace: list[tuple[str, str]] = []
            whole = self._merge(token, trace) == [token]
            scores = [self.score[a + b] for a, b in trace]
            regular = whole and all(a > b for a, b in zip(scores, scores[1:]))
            self.splits[token] = trace[-1] if regular and trace else None
        return self.splits[token]

    def _undo(self, left: str, right: str) -> bool | None:
        """Pair test from the last merges back to the first; None: not decidable this way."""
        limit, inclusive = float("-inf"), False  # scores better than this came before
        while True:
            score = self.score.get(left + right)
            if score is not None and (score > limit or inclusive and score == limit):
                return False
            if len(left) == 1 and len(right) == 1:
                return True
            l_score = self.score[left] if len(left) > 1 else float("inf")
            r_score = self.score[right] if len(right) > 1 else float("inf")
            parts = self._split(left if l_score < r_score else right)
            if parts is None:
                return None
            if l_score < r_score:
                limit, inclusive, left = l_score, False, parts[1]
            else:  # of equal merges the left one comes first, so the right one is undone first
                limit, inclusive, right = r_score, True, parts[0]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether token ``right`` can follow ``left`` (-1: nothing) in an encoding."""
        parts = [self.names[x] for x in (left, right) if x >= 0]
        regular = len(parts) == 2 and all(len(x) == 1 or self._split(x) for x in parts)
        known = self._undo(*parts) if regular else None
        if known is None:
            known = self._merge("".join(parts)) == parts
        if len(self.pairs) >= _CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[(left << 21) + right] = known
        return known

    def _lone(self, c: str) -> int:
        number = self.lone.setdefault(c, len(self.surface) + len(self.lone))
        self.names[number] = c
        return number

    def _extend(self, unit: str, last: list[int], states: list[int]) -> None:
        """Prefix table of ``unit``, going on from that of a prefix.  last[i]: last token of the
        encoding of the first i characters (-1: none); states[i]: the automaton's state behind them."""
        at, state = len(last) - 1, states[-1]
        steps, ends, known = self.step, self.ends, self.pairs.get
        for c in unit[at:]:
            at += 1
            state = steps[state].get(c) or self._follow(state, c)
            states.append(state)
            for piece, length in ends[state]:
                left = last[at - length]
                fits = known((left << 21) + piece)
                if fits is None:
                    fits = self._compatible(left, piece)
                if fits:
                    last.append(piece)
                    break
            else:  # a character outside the vocabulary stands alone
                last.append(self._lone(c))
        return last

    def _ids_of(self, unit: str, last: list[int]) -> tuple[int, ...]:
        at, out, lone = len(unit), [], len(self.surface)
        while at:
            token = last[at]
            if token < lone:
                out.append(token)
                at -= self.lengths[token]
            else:
                at -= 1
                out.extend([self.byte_ids[b] for b in reversed(unit[at].encode())])
        out.reverse()
        return tuple(out)

    def _unit_ids(self, unit: str) -> tuple[int, ...]:
        ids = self.older.get(unit)
        if ids is None:
            last = [-1]
            self._extend(unit, last, [0])
            ids = self._ids_of(unit, last)
        self._remember(unit, ids)
        return ids

    def _remember(self, unit: str, ids: tuple[int, ...]) -> None:
        if len(unit) <= _LONG_UNIT:
            if len(self.units) >= _CACHE_UNITS:  # what was not asked for again goes
                self.units, self.older = {}, self.units
            self.units[unit] = ids

    def _learn(self, units: set[str]) -> None:
        """Encode and remember units in their order: the prefix table of each goes on from where
        it parts from the one before."""
        before, last, states = "", [-1], [0]
        for unit in sorted(units):
            same = 0
            for x, y in zip(before, unit):
                if x != y:
                    break
                same += 1
            del last[same + 1:], states[same + 1:]
            self._extend(unit, last, states)
            self._remember(unit, self._ids_of(unit, last))
            before = unit

    def encode(self, text: str) -> list[int]:
        """Ids of ``text``, without an end id."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of every text, without end ids."""
        split = [self.unit.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        new = set().union(*split).difference(self.units, self.older)
        self._learn({u for u in new if len(u) <= _LONG_UNIT})
        make, out = self._unit_ids, []
        for units in split:
            parts = []
            for at in range(0, len(units), 4096):
                get = self.units.get
                parts.append([get(u) or make(u) for u in units[at:at + 4096]])
            out.append(list(chain.from_iterable(chain.from_iterable(parts))))
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids``; the dummy prefix goes, bytes that form no character become U+FFFD each."""
        first = next((i for i in ids if i not in self.control), None)
        surface = self.surface
        joined = b"".join([surface[i] for i in ids])
        if first is not None and first not in self.byte_of and first != self.unknown and joined[:1] == b" ":
            joined = joined[1:]
        try:
            return joined.decode()
        except UnicodeDecodeError:
            return self._decode_slowly(ids)

    def _decode_slowly(self, ids: list[int]) -> str:
        out, run, stripped = [], bytearray(), False

        def flush() -> None:
            rest = bytes(run)
            while rest:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(rest[:n].decode())
                        rest = rest[n:]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    rest = rest[1:]
            run.clear()

        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                stripped = True
                continue
            flush()
            text = self.surface[i].decode()
            if not stripped and i not in self.control:
                stripped = True
                text = text[1:] if i != self.unknown and text.startswith(" ") else text
            out.append(text)
        flush()
        return "".join(out)


@functools.lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    """The model of a path, loaded once in each Python worker."""
    return PieceModel(path)


FORGET.append(model.cache_clear)


#: Text encoded at once.
_SLICE_BYTES = 4_000_000


def encode_texts(df: DataFrame, path: str, text: str = "text", ids: str = "piece_ids",
                 decoded: str = "decoded_text", end: bool = True) -> DataFrame:
    """``df`` with the ids of every whole text and the text decoded from them.

    Columns named like the two results are replaced.
    """
    from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

    kept = df.drop(ids, decoded)
    schema = StructType(kept.schema.fields + [
        StructField(ids, ArrayType(IntegerType())), StructField(decoded, StringType())])

    def encoded(m: PieceModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.schema.get_field_index(text)
            behind = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            starts = np.flatnonzero(np.diff(behind // _SLICE_BYTES, prepend=-1)).tolist()
            for at, to in zip(starts, [*starts[1:], batch.num_rows]):
                rows = batch.slice(at, to - at)
                flat, sizes, texts = [], [0], []
                for own in m.encode_all([value or "" for value in rows.column(column).to_pylist()]):
                    if end:
                        own.append(m.end)
                    texts.append(m.decode(own))
                    flat.append(np.array(own, np.int32))
                    sizes.append(sizes[-1] + len(own))
                values = pa.array(np.concatenate(flat), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), values), pa.array(texts, pa.string())],
                    names=[*rows.schema.names, ids, decoded])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from encoded(model(path), batches)

    return kept.mapInArrow(run, schema)
