"""A context-mixing range coder for token ids; many blocks are coded side by side.

Every block starts from nothing and is coded on its own. Orders 2 and 1 each predict one
id: the one that last followed the same two ids, or the same id. Order 0 knows how often
ids occurred. The odds that the better prediction is right, as each order sees them, are
mixed in the logistic domain with weights that learn from every id, and a range coder
codes whether it was right. If not, the id is coded by the counts of order 0, which are
brought up to date now and then, or in full if it is new to the block.

One step codes the next id of all blocks at once, and arrays of a step lie together, the
two predicting orders as rows of one array and the three mixed ones of another: what a step
costs is mostly the number of calls. All state is whole numbers, so that a reader computes
the very numbers the writer did; weights and spans keep them as doubles, far below 2 ** 53,
as numpy multiplies and divides those faster than integers.
"""

from __future__ import annotations

import math

import numpy as np

IDS = 1 << 16
SLOTS = 1 << 12
# Steps after which the counts of order 0 are brought up to date.
FIRST_UPDATES, UPDATE_EVERY = (32, 64, 128, 256), 512
# Steps that are coded with the same blocks, of which some may end on the way; divides those above.
AHEAD = 32
# Blocks whose ids are sorted at a time.
SORTED = 128
TOP = float(1 << 48)
SMALL = float(1 << 32)
WORD = float(1 << 16)
WORDS_PER_ID = 3

_X = np.arange(-2047, 2049)
# A chance of 4096 by the mixed odds, and back.
SQUASH = np.array([min(4095, max(1, round(4096 / (1 + math.exp(-x / 256))))) for x in _X.tolist()], np.float64)
STRETCH = np.array([round(256 * math.log((p + 0.5) / (4095.5 - p))) for p in range(4096)], np.float64)
# Where an order's chance lies: by how often the id occurred (order 0), or by how sure orders 2 and 1
# are and whether both predict the same (sure << 3 | sure << 1 | same).
CLASS = np.array([16 + min(7, int(n).bit_length()) for n in range(256)], np.int64)
_SURE = np.arange(32) >> 3, np.arange(32) >> 1 & 3
FIRST = _SURE[0] >= np.maximum(_SURE[1], 1)  # order 2 is believed
_SAME = np.arange(32) & 1
CELLS = np.stack([(_SURE[0] << 1) + (_SAME | FIRST), 8 + (_SURE[1] << 1) + (_SAME | ~FIRST)])
# A chance after a miss, and from 4096 on after a hit.
NEXT = np.array([max(1, c + (truth - c >> 5)) for truth in (0, 4096) for c in range(4096)], np.int64)


def _slots(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Slots of orders 2 and 1 by the last id and the one before (uint16: only 16 bits of products count)."""
    slots = np.empty((2, len(one)), np.uint16)
    np.multiply(one, 40503, out=slots[1])
    before = two * np.uint16(30637)
    before += two >> 5
    np.add(slots[1], before, out=slots[0])
    slots >>= 4
    return slots


def _updated(step: int) -> bool:
    return step in FIRST_UPDATES or step > 0 and step % UPDATE_EVERY == 0


def _groups(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The ids of each block sorted; of each group of equal ones, its place among the ids of all blocks
    and of its own, and its size."""
    n, known = ids.shape
    ids = np.sort(ids.astype(np.uint32), axis=1)  # sorted faster than short integers
    new = np.ones(ids.shape, bool)
    np.not_equal(ids[:, 1:], ids[:, :-1], out=new[:, 1:])
    first = np.flatnonzero(new)
    return ids, first, first - first // known * known, np.diff(first, append=n * known)


def _counts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of each block sorted; where equal ones begin, and how many they are."""
    ids, _, begin, sizes = _groups(ids)
    return ids, np.repeat(begin, sizes), np.repeat(sizes, sizes)


def _next_update(step: int) -> int:
    return min([u for u in FIRST_UPDATES if u > step] + [(step // UPDATE_EVERY + 1) * UPDATE_EVERY])


def _ahead(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By step and block, where each of the ``wanted`` ids begins among the sorted ``ids`` of its
    block, and how many there are; those that are not there come after all others."""
    n, known = ids.shape
    begins, counts = (np.empty((wanted.shape[1], n)) for _ in range(2))
    for a in range(0, n, SORTED):
        held, first, begin, sizes = _groups(ids[a:a + SORTED])
        group_of, asked = np.full(IDS, -1), wanted[a:a + SORTED]
        held, number, cut = held.ravel()[first], np.arange(len(first)), np.searchsorted(first, np.arange(len(held)) * known)
        group = np.empty(asked.shape, np.int64)
        for row, of, lo, hi in zip(group, asked, cut, [*cut[1:], len(first)]):
            group_of[held[lo:hi]] = number[lo:hi]
            row[:] = group_of[of]
        there = group >= cut[:, None]  # or of a block before, or of none
        begins[:, a:a + SORTED] = np.where(there, begin[group], known).T
        counts[:, a:a + SORTED] = (sizes[group] * there).T
    return begins, counts


def _held(ids: np.ndarray) -> np.ndarray:
    """The sorted ids of each block with where equal ones begin << 16 and how many they are << 32.

    After those of a block comes one that begins there, for ids that are new to it.
    """
    known, n = ids.shape
    held = np.empty((n, known + 1), np.int64)
    held[:, known] = known << 16
    for a in range(0, n if known else 0, SORTED):
        ordered, first, begin, sizes = _groups(ids[:, a:a + SORTED].T)
        groups = (sizes << 16 | begin) << 16 | ordered.ravel()[first]
        held[a:a + SORTED, :known] = np.repeat(groups, sizes).reshape(ordered.shape)
    return held.ravel()


class _Blocks:
    """The model of all blocks: ``lanes`` blocks of which the longest come first."""

    def __init__(self, lanes: int):
        # The table of order 1 comes after that of order 2. A slot of all blocks lies together, as they
        # often use the same.
        self.lanes = lanes
        self.all_bases = np.arange(lanes) + np.array([[0], [lanes * SLOTS]])
        self.after = np.zeros(2 * lanes * SLOTS, np.int32)  # id << 2 | confidence
        self.seen = np.zeros(lanes * SLOTS, np.uint8)
        self.right = np.full(lanes * 24, 1024, np.int64)
        self.weight = np.full((3, lanes), float(1 << 15))
        self.novel = np.ones(lanes)

    def narrow(self, n: int) -> None:
        """Go on with the first ``n`` blocks."""
        self.n = n
        self.bases = self.all_bases[:, :n].copy()
        self.base = self.bases[0]
        self.cells = np.tile(np.arange(n) * 24, (3, 1))
        self.weight = self.weight[:, :n].copy()

    def after_at(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Places of orders 2 and 1 by the last id and the one before."""
        places = np.multiply(_slots(one, two), self.lanes, dtype=np.int64)
        places += self.bases
        return places

    def seen_at(self, ids: np.ndarray) -> np.ndarray:
        places = (ids & SLOTS - 1) * self.lanes  # below 2 ** 31 up to 2 ** 19 blocks
        return places + self.base

    def predict(self, at: np.ndarray) -> np.ndarray:
        """The predicted id of each block; ``self.odds`` is the chance (of 4096) that it is right.

        ``at`` has the places of orders 2 and 1.
        """
        self.at, self.of = at, self.after.take(at)
        self.sure = self.of & 3
        believed = (self.sure[0] << 3) + (self.sure[1] << 1)
        believed += (self.of[0] ^ self.of[1]) < 4
        believed = believed.astype(np.intp)
        guess = np.where(FIRST.take(believed), self.of[0], self.of[1]) >> 2
        self.cell = self.cells.copy()
        self.cell[:2] += CELLS.take(believed, axis=1)
        self.cell[2] += CLASS.take(self.seen.take(self.seen_at(guess)))
        self.chance = self.right.take(self.cell)
        self.pull = STRETCH.take(self.chance)
        mixed = np.add.reduce(self.weight * self.pull, axis=0)
        mixed *= 2.0 ** -16
        mixed += 2047  # whole numbers below 0 and fractions around it end in the first place alike
        self.odds = SQUASH.take(mixed.astype(np.intp), mode="clip")
        return guess

    def learn(self, ids: np.ndarray, place: np.ndarray, hit: np.ndarray) -> None:
        """Take in the ids of this step (int32), whose places in ``seen`` are given."""
        truth = np.where(hit, 4096, 0)
        self.chance += truth
        self.right[self.cell] = NEXT.take(self.chance)
        error = truth - self.odds
        error *= 2.0 ** -10
        self.pull *= error
        self.weight += np.floor(self.pull, out=self.pull)
        of, ids = self.of, ids << 2
        same = (of ^ ids) < 4
        # Less sure or replaced, or surer.
        then = np.where(self.sure > 1, of - 1, ids + 1)
        of += 1
        np.copyto(then, np.minimum(of, ids + 3), where=same)
        self.after[self.at] = then
        self.seen[place] = np.minimum(self.seen.take(place), 254) + 1


def _active(sizes: np.ndarray) -> list[int]:
    """For every step, how many blocks (longest first) still have an id."""
    longest = int(sizes[0]) if len(sizes) else 0
    return (len(sizes) - np.searchsorted(sizes[::-1], np.arange(longest), "right")).tolist()


def _share(span: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``span // total``: as spans have 49 bits at most, doubles round no quotient up to a whole number."""
    found = span / total
    return np.floor(found, out=found)


class _Writer:
    """Range coders of all blocks. A position may be ``TOP`` or more when its next word is written;
    these carries go back into the words before when all are written."""

    def __init__(self, lanes: int, length: int):
        self.low = np.zeros(lanes)
        self.range = np.full(lanes, TOP)
        # The n-th words of all blocks lie together, as they are written at about the same time.
        self.words = np.zeros((length * WORDS_PER_ID + 4) * lanes, np.int32)
        self.place = np.arange(lanes)

    def put(self, lanes: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Write the first word of the positions of ``lanes``; what is left of them."""
        place = self.place[lanes]
        word = np.floor(low * (1 / SMALL))
        self.words[place] = word.astype(np.int32)
        place += len(self.low)
        self.place[lanes] = place
        return (low - word * SMALL) * WORD

    def shift(self, low: np.ndarray, span: np.ndarray) -> None:
        """Write full words of the first blocks; positions and ranges are changed in place."""
        full = np.flatnonzero(span < SMALL)
        if len(full):
            low[full] = self.put(full, low[full])
            span[full] *= WORD

    def finished(self) -> list[bytes]:
        """The code of each block: its words and the 48 bits of its position."""
        lanes, low = np.arange(len(self.low)), self.low
        for _ in range(3):
            low = self.put(lanes, low)
        sizes = self.place // len(low)
        rows = self.words.reshape(-1, len(low))[:sizes.max()]
        carry = np.zeros(len(low), np.int32)
        for row in rows[::-1]:
            row += carry
            np.right_shift(row, 16, out=carry)
        found: list[bytes] = []
        for lane in range(0, len(low), SORTED):
            part = rows[:, lane:lane + SORTED].T.astype("<u2")
            found += [words[:n].tobytes() for words, n in zip(part, sizes[lane:lane + SORTED].tolist())]
        return found


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """The code of each block of ids below 65,536."""
    if not blocks:
        return []
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    sizes = np.array([len(blocks[i]) for i in order])
    longest = int(sizes[0])
    # Two steps of nothing come before the first id.
    ids = np.zeros((len(blocks), longest + 2), np.uint16)
    for row, i in enumerate(order):
        ids[row, 2:2 + len(blocks[i])] = blocks[i]
    model, out, active = _Blocks(len(blocks)), _Writer(len(blocks), longest), _active(sizes)
    known = since = 0
    begins = counts = np.zeros((AHEAD, len(blocks)))
    for step in range(0, longest, AHEAD):
        until, n = min(step + AHEAD, longest), active[step]
        model.narrow(n)
        if _updated(step):
            known, since = step, step
            begins, counts = _ahead(ids[:n, 2:2 + step], ids[:n, 2 + step:2 + min(longest, _next_update(step))])
        symbols = np.ascontiguousarray(ids[:n, step:until + 2].T)
        slots = [model.after_at(one, two) for one, two in zip(symbols[1:], symbols)]
        symbols = symbols[2:].astype(np.int32)
        places = model.seen_at(symbols)
        unknown = counts[step - since:until - since] == 0
        for k, (symbol, slot, place, m) in enumerate(zip(symbols, slots, places, active[step:until])):
            hit = model.predict(slot) == symbol
            # Only blocks that go on are written; what the model makes of the others is not used.
            low, span, novel, hits = out.low[:m], out.range[:m], model.novel[:m], hit[:m]
            missed = 1.0 - hits
            bound = np.floor(span * 2.0 ** -12)
            bound *= model.odds[:m]
            span[:] = np.where(hits, bound, span - bound)
            bound *= missed
            low += bound
            out.shift(low, span)
            # The id, of all that there are, where the prediction was wrong.
            at = step - since + k
            unit, new = _share(span, novel + known), unknown[k, :m]
            span[:] = np.where(hits, span, unit * np.where(new, novel, counts[at, :m]))
            unit *= begins[at, :m]
            unit *= missed
            low += unit
            out.shift(low, span)
            fresh = np.flatnonzero(new > hits)
            if len(fresh):
                unit = np.floor(span[fresh] * (1 / WORD))
                low[fresh] = out.put(fresh, low[fresh] + unit * symbol[fresh])
                span[fresh] = unit * WORD
                novel[fresh] += 1
            model.learn(symbol, place, hit)
    codes: list[bytes] = [b""] * len(blocks)
    for i, code in zip(order, out.finished()):
        codes[i] = code
    return codes


def decode(codes: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids (uint32) of each block; ``sizes`` says how many. A damaged code gives other ids."""
    if not codes:
        return []
    order = sorted(range(len(codes)), key=lambda i: -sizes[i])
    lengths = np.array([sizes[i] for i in order])
    longest = int(lengths[0])
    lanes = len(codes)
    # The n-th words of all blocks lie together, as they are read at about the same time.
    words = np.zeros((max(len(c) for c in codes) // 2 + 4, lanes), np.uint16)
    for row, i in enumerate(order):
        code = np.frombuffer(codes[i][:len(codes[i]) // 2 * 2], "<u2")
        words[:len(code), row] = code
    read = np.arange(lanes) + 3 * lanes
    all_positions = np.array([SMALL, WORD, 1.0]) @ words[:3]
    words = words.ravel()
    all_widths = np.full(lanes, TOP)
    past = np.zeros((longest, lanes), np.uint16)
    model, active = _Blocks(lanes), _active(lengths)

    def get(some: np.ndarray, position: np.ndarray) -> np.ndarray:
        """The positions of some blocks with one more word."""
        at = read[some]
        read[some] = at + lanes
        # The bounds only matter to damaged codes, and to blocks that have ended.
        return np.minimum(position * WORD + words.take(at, mode="clip"), TOP - 1)

    def shift(position: np.ndarray, width: np.ndarray) -> None:
        """Read words of the first blocks; positions and ranges are changed in place."""
        full = np.flatnonzero(width < SMALL)
        if len(full):
            position[full] = get(full, position[full])
            width[full] *= WORD

    known, held, row = 0, _held(past[:0]), np.arange(lanes)
    one = two = np.zeros(lanes, np.uint16)
    for step in range(0, longest, AHEAD):
        until, n = min(step + AHEAD, longest), active[step]
        model.narrow(n)
        if _updated(step):
            known, held = step, _held(past[:step, :n])
        one, two, rows = one[:n], two[:n], row[:n] * (known + 1)
        position, width, novel = all_positions[:n], all_widths[:n], model.novel[:n]
        for k in range(step, until):
            guess = model.predict(model.after_at(one, two))
            bound = np.floor(width * 2.0 ** -12)
            bound *= model.odds
            hit = position < bound
            missed = 1.0 - hit
            width[:] = np.where(hit, bound, width - bound)
            bound *= missed
            position -= bound
            shift(position, width)
            # The id, of all that there are, where the prediction was wrong.
            unit = _share(width, novel + known)
            at = np.minimum(position / unit, known).astype(np.intp)
            found = held.take(rows + at)
            new = at == known
            width[:] = np.where(hit, width, unit * np.where(new, novel, found >> 32))
            symbol = np.where(hit, guess, found & 0xFFFF).astype(np.int32)
            found >>= 16
            found &= 0xFFFF
            unit *= found
            unit *= missed
            position -= unit
            shift(position, width)
            fresh = np.flatnonzero(new > hit)
            if len(fresh):
                unit, inner = np.floor(width[fresh] * (1 / WORD)), position[fresh]
                full_id = np.minimum(_share(inner, unit), IDS - 1)
                position[fresh] = get(fresh, inner - unit * full_id)
                width[fresh] = unit * WORD
                symbol[fresh] = full_id
                novel[fresh] += 1
            model.learn(symbol, model.seen_at(symbol), hit)
            one, two = symbol.astype(np.uint16), one
            past[k, :n] = one
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * lanes
    for lane, i in enumerate(order):
        out[i] = past[:sizes[i], lane].astype(np.uint32)
    return out
