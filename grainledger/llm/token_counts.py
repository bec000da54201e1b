"""Token counts: a piece vocabulary compiled to a deterministic transducer; chunk state maps composed by a scan."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import slices

#: The sign that stands for a blank in pieces.
BLANK = "▁"
#: The state at a text's start: the suffix, then for each of its places the last token before it and the count there,
#: seen from the end.
ANEW = ("", None, 0)
#: Characters whose state map is made at once, and characters between two marks of a map.
CHUNK, MARK = 1 << 15, 64
#: Units of up to so many characters are read together, and what they begin alike is read once; others one by one.
SHORT = 64
#: Text whose distinct words are counted together.
STRIP = 1 << 21
#: States and words that a task remembers at most; past that it starts anew, at the same results.
STATES, WORDS = 150_000, 300_000


def load_pieces(path: str) -> dict[str, int]:
    """The pieces that merges can make, with their rank (smaller merges first), from a piece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.encode(" a  b ", out_type=str) != [BLANK, BLANK + "a", BLANK, BLANK + "b", BLANK]:
        raise ValueError("only models that put one blank in front and keep all white space are supported")
    found = [
        (-model.get_score(i), i, model.id_to_piece(i))
        for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))
    ]
    pieces = {p: rank for rank, (_, _, p) in enumerate(sorted(found))}
    if any(a != BLANK and b == BLANK for p in pieces for a, b in zip(p, p[1:])):
        raise ValueError("a piece with a blank behind another character joins words; such models are not supported")
    return pieces


class Transducer:
    """Reads characters and emits, on every transition, by how much the token count of the text so far changes.

    In a merge tokenizer the last token of a prefix is the one vocabulary suffix that stays apart from the token
    before it when both are merged on their own. So it can be told from the last tokens at the places where a piece
    that is still under way may begin, and these places are the state. They lie within the longest suffix that some
    piece begins with, so there are finitely many states; transitions are made when first met. A blank after another
    character always starts anew, from the same state.
    """

    def __init__(self, pieces: dict[str, int]) -> None:
        self.pieces = pieces
        self.begun = {p[:n] for p in pieces for n in range(1, len(p))}
        self.pairs: dict[str, dict[str | None, bool]] = {}
        self.own: dict[str, bool] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        self.clear()

    def clear(self) -> None:
        self.pairs.clear()
        self.plans: dict[str, tuple] = {}
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: dict[int, int] = {}
        self.sorted = np.full((2, 1), 1 << 62)  # one column stands behind all keys
        self.start = self._state(ANEW)

    def _state(self, held: tuple) -> int:
        found = self.ids.get(held)
        if found is None:
            found = self.ids[held] = len(self.states)
            self.states.append(held)
        return found

    def merge(self, text: str) -> list[str]:
        """The merges themselves, on a short text."""
        parts = list(text)
        while len(parts) > 1:
            ranks = [self.pieces.get(a + b) for a, b in zip(parts, parts[1:])]
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _split(self, piece: str) -> tuple[str, str]:
        """The two parts that the last merge of a piece joins."""
        if piece not in self.parts:
            parts = list(piece)
            while len(parts) > 2:
                ranks = [self.pieces.get(a + b, len(self.pieces)) for a, b in zip(parts, parts[1:])]
                i = ranks.index(min(ranks))
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self.parts[piece] = (parts[0], parts[1])
        return self.parts[piece]

    def _apart(self, a: str | None, b: str) -> bool:
        """Whether a and b, side by side, end up as just these two tokens.

        Their merges are undone from the latest to the earliest. If the two parts that meet could be joined by a merge
        that comes before the one just undone, it would have been made instead.
        """
        if a is None or (b[0] == BLANK and a[-1] != BLANK):
            return True
        rank, limit = self.pieces, len(self.pieces) + 1
        while True:
            if rank.get(a + b, limit) < limit:
                return False
            made_a = rank[a] if len(a) > 1 else -1
            made_b = rank[b] if len(b) > 1 else -1
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                limit, a = made_a, self._split(a)[1]
            else:  # of equal merges the left one comes first
                limit, b = made_b + 1, self._split(b)[0]

    def _whole(self, piece: str) -> bool:
        if piece not in self.own:
            self.own[piece] = len(piece) == 1 or (piece in self.pieces and self.merge(piece) == [piece])
        return self.own[piece]

    def _places(self, suffix: str) -> list[int]:
        """Where a piece under way may begin, and the end: only these places of a suffix are kept."""
        return [i for i in range(len(suffix)) if suffix[i:] in self.begun] + [len(suffix)]

    def _plan(self, text: str) -> tuple:
        """What a character does to every state whose suffix stands before it in text.

        The pieces that may be the last token, longest first, each with the kept place where it begins, its cost and the
        tokens that it was compared with; the suffix that goes out; and which kept places stay.
        """
        before = self._places(text[:-1])
        pieces = tuple(
            # an unknown character becomes its bytes
            (2 * at + 1, text[i:], 1 if text[i:] in self.pieces else len(text[i:].encode()), self.pairs.setdefault(text[i:], {}))
            for at, i in enumerate(before)
            if self._whole(text[i:])
        )
        after = set(self._places(text))
        skip = min(after)
        return pieces, text[skip:], tuple(2 * at + 1 for at, i in enumerate(before) if i in after)

    def step(self, state: int, char: str) -> tuple[int, int]:
        move = self.moves.get(state << 21 | ord(char))
        if move is None:
            move = self._move(state, char)
        return move >> 16, (move & 0xFFFF) - 0x8000

    def _move(self, state: int, char: str) -> int:
        """A transition met for the first time: the state that goes out and the change of the count, in one number."""
        held = self.states[state]
        last = held[-2]
        if char == BLANK and last is not None and last[-1] != BLANK:
            held = ANEW
        text = held[0] + char
        plan = self.plans.get(text)
        if plan is None:
            plan = self.plans[text] = self._plan(text)
        pieces, suffix, kept = plan
        for at, piece, cost, known in pieces:
            before = held[at]
            apart = known.get(before)
            if apart is None:
                apart = known[before] = self._apart(before, piece)
            if apart:
                break
        delta = held[at + 1] + cost
        after = [suffix]
        for at in kept:
            after += (held[at], held[at + 1] - delta)
        after += (piece, 0)
        move = self.moves[state << 21 | ord(char)] = self._state(tuple(after)) << 16 | delta + 0x8000
        return move

    def run(self, state: int, text: str) -> tuple[int, int]:
        total, moves = 0, self.moves
        for char in text:
            move = moves.get(state << 21 | ord(char))
            if move is None:
                move = self._move(state, char)
            state = move >> 16
            total += (move & 0xFFFF) - 0x8000
        return state, total

    def _sorted_moves(self) -> np.ndarray:
        """Keys of the transitions met so far, in order, and the transitions; those met since the last call are added."""
        fresh = np.array(list(islice(self.moves.items(), self.sorted.shape[1] - 1, None)), np.int64).reshape(-1, 2).T
        fresh = fresh[:, np.argsort(fresh[0])]
        self.sorted = np.insert(self.sorted, np.searchsorted(self.sorted[0], fresh[0]), fresh, axis=1)
        return self.sorted

    def run_all(self, texts: list[str]) -> np.ndarray:
        """The change of the token count over each text, from the start state.

        The texts are read side by side in sorted order, a character of each at a time. Where a text begins like the
        one before it, the two are in one state, and only one of them is read.
        """
        total = np.zeros(len(texts), np.int64)
        if not texts:
            return total
        order = sorted(range(len(texts)), key=texts.__getitem__)
        texts = [texts[i] for i in order]
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        chars = np.array(texts).view(np.uint32).reshape(len(texts), -1)
        alike = chars[1:] == chars[:-1]
        alike = np.where(alike.all(axis=1), chars.shape[1], alike.argmin(axis=1))
        alike = np.append(-1, np.minimum(alike, np.minimum(size[1:], size[:-1])))
        rows, state = np.arange(len(texts)), np.full(len(texts), self.start)
        moves, low = self.moves, (1 << 21) - 1
        met, leads = self._sorted_moves()
        for k in range(chars.shape[1]):
            going = size[rows] > k
            rows, state = rows[going], state[going]
            if not len(rows):
                break
            own = alike[rows] <= k
            keys, which = np.unique(state[own] << 21 | chars[rows[own], k], return_inverse=True)
            at = np.searchsorted(met, keys)
            found = leads[at]
            new = np.flatnonzero(met[at] != keys)
            found[new] = [moves.get(key) or self._move(key >> 21, chr(key & low)) for key in keys[new].tolist()]
            move = found[which][np.cumsum(own) - 1]
            state = move >> 16
            total[rows] += (move & 0xFFFF) - 0x8000
        out = np.empty_like(total)
        out[order] = total
        return out


class ChunkMap:
    """What a chunk does to any state that comes in: the state that goes out, and the change of the token count.

    The chunk is read once from the start state, and every MARK characters the state and the count so far are kept.
    From another state it is read only until both readings are in one state at a mark: from there on they agree.
    """

    def __init__(self, machine: Transducer, text: str) -> None:
        self.machine, self.text = machine, text
        self.states, self.counts = array("q"), array("q")
        state, total = machine.start, 0
        for i in range(0, len(text), MARK):
            state, delta = machine.run(state, text[i : i + MARK])
            total += delta
            self.states.append(state)
            self.counts.append(total)

    def __call__(self, state: int) -> tuple[int, int]:
        if state == self.machine.start:
            return self.states[-1], self.counts[-1]
        total = 0
        for mark, i in enumerate(range(0, len(self.text), MARK)):
            state, delta = self.machine.run(state, self.text[i : i + MARK])
            total += delta
            if state == self.states[mark]:
                return self.states[-1], total + self.counts[-1] - self.counts[mark]
        return state, total


class Composed:
    """Two neighbouring maps as one. Composing is associative, so neighbours are composed in a tree."""

    def __init__(self, first: Callable, second: Callable) -> None:
        self.first, self.second = first, second

    def __call__(self, state: int) -> tuple[int, int]:
        state, before = self.first(state)
        state, count = self.second(state)
        return state, before + count


class Counter:
    """Counts tokens of texts with one transducer, and remembers words.

    A blank after another character leads every state to one and the same. So the map of a unit (blanks and the word
    behind them) is constant: it is found once for each distinct unit, and composing units is adding up their counts.
    """

    def __init__(self, pieces: dict[str, int]) -> None:
        self.machine = Transducer(pieces)
        self.words: dict[str, int] = {}

    def unit(self, text: str) -> int:
        """Tokens of blanks and a word, from the start state; a long one in chunks."""
        machine = self.machine
        if len(text) <= CHUNK:
            return machine.run(machine.start, text)[1]
        maps: list[Callable] = [ChunkMap(machine, text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)]
        while len(maps) > 1:
            maps = [Composed(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0](machine.start)[1]

    def units(self, texts: list[str]) -> np.ndarray:
        """The same of many units; short ones are read together."""
        out = np.zeros(len(texts), np.int64)
        most = min(SHORT, CHUNK)
        short = np.fromiter((len(t) <= most for t in texts), bool, len(texts))
        out[short] = self.machine.run_all([t for t in texts if len(t) <= most])
        for i in np.flatnonzero(~short).tolist():
            out[i] = self.unit(texts[i])
        return out

    def each(self, words: list[str]) -> list[int]:
        """Tokens of one blank and each of some distinct words."""
        found = list(map(self.words.get, words))
        new = [i for i, n in enumerate(found) if n is None]
        if len(self.words) + len(new) > WORDS:
            self.words.clear()
        for i, n in zip(new, self.units([BLANK + words[i] for i in new]).tolist()):
            found[i] = n
            if len(words[i]) <= SHORT and len(self.words) < WORDS:
                self.words[words[i]] = n
        return found

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of every text, each distinct unit of all of them counted once. A null is an empty text."""
        if len(self.machine.states) > STATES:
            self.machine.clear()
        texts = texts.fill_null("").cast(pa.large_string())
        parts = pc.split_pattern(pc.replace_substring(texts, BLANK, " "), " ")
        many = np.asarray(parts.value_lengths(), np.int64)
        row = np.repeat(np.arange(len(texts)), many)
        coded = parts.flatten().dictionary_encode()
        code, words = np.asarray(coded.indices, np.int64), coded.dictionary.to_pylist()
        filled = np.array([bool(w) for w in words], bool)[code]
        # blanks that stand before a word or at a text's end, beside the one that each part has in front
        at, last = np.flatnonzero(filled), np.cumsum(many) - 1
        first = last - many + 1
        before = at - np.maximum(np.append(-1, at[:-1]), first[row[at]] - 1) - 1
        plain = before == 0
        total = np.zeros(len(texts), np.int64)
        own = np.zeros(len(words), np.int64)
        own[code[at[plain]]] = 1
        met = np.flatnonzero(own)
        own[met] = self.each([words[i] for i in met.tolist()])
        np.add.at(total, row[at[plain]], own[code[at[plain]]])
        far, which = np.unique(before[~plain] * len(words) + code[at[~plain]], return_inverse=True)
        each = self.units([BLANK * (k // len(words) + 1) + words[k % len(words)] for k in far.tolist()])
        np.add.at(total, row[at[~plain]], each[which])
        final = np.full(len(texts), -1)
        np.maximum.at(final, row[at], at)
        trail = np.where(final >= 0, last - final, np.where(np.asarray(pc.binary_length(texts)) > 0, many, 0))
        for k in np.unique(trail[trail > 0]).tolist():
            total[trail == k] += self.unit(BLANK * k)
        return total

    def count(self, text: str) -> int:
        return int(self.counts(pa.array([text]))[0])


def token_counts(docs: DataFrame, pieces: dict[str, int], limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text, as the piece model's library counts.

    No begin, end or other special tokens are added, and their strings inside a text are ordinary text. A null or
    empty text has no bytes and no tokens. Every row gets a row, repeated rows and null ids too; extra columns are
    not looked at; an empty table gives no rows. Texts are read in strips of about STRIP bytes; a longer one is a strip
    of its own, and its words are cut into chunks where they are long.
    """
    shared = docs.sparkSession.sparkContext.broadcast((pieces, {}))  # the vocabulary; the dict is the worker's own

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, kept = shared.value
        counter = kept.get("counter") or kept.setdefault("counter", Counter(vocabulary))
        for batch in batches:
            for part in slices(batch, "text", STRIP):
                tokens = counter.counts(part.column(1))
                size = pc.binary_length(part.column(1).fill_null("")).cast(pa.int64())
                yield pa.record_batch(
                    [part.column(0), size, pa.array(tokens), pa.array(tokens > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
