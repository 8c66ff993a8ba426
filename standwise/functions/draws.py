"""Seeded draws of many fixtures at once: MD5 over arrays of texts, and the wins they mean.

A task of a season hashes a text per fixture and block of scenarios; one by one that is
most of its time.  All texts of a batch take the same 64 steps, so each step is one
operation on an array.
"""

from collections.abc import Iterator

import numpy as np

# One hash of 32 hex digits serves four scenarios, eight digits each.
LANES = 4

# Hashes worked out at once: their arrays stay in a core's cache.
AT_ONCE = 32768

# Fixed values of MD5 (RFC 1321): shifts, sines, and the word each step takes.  They are arrays
# without a dimension, which numpy takes without converting them at each of the steps.
_SHIFTS = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]
_LEFT = [[np.array(x, np.uint32) for x in row] for row in _SHIFTS]
_RIGHT = [[np.array(32 - x, np.uint32) for x in row] for row in _SHIFTS]
_SINES = [np.array(int(abs(np.sin(i + 1)) * 2**32), np.uint32) for i in range(64)]
_WORDS = [(0, 1), (1, 5), (5, 3), (0, 7)]
_START = [0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476]


def md5_lanes(words: list, shape: tuple[int, ...]) -> list[np.ndarray]:
    """The four eight-digit numbers of the MD5 of texts of equally many 64-byte pieces.

    ``words`` hold, for each little-endian word of the padded texts, an array with a place
    for each text, one without a dimension where it is the same in all of them, or None where
    it is zero in all of them.
    """
    add, xor, either = np.add, np.bitwise_xor, np.bitwise_or
    state = [np.full(shape, x, np.uint32) for x in _START]
    spare, part = np.empty(shape, np.uint32), np.empty(shape, np.uint32)
    for piece in range(0, len(words), 16):
        before = [x.copy() for x in state] if piece else _START
        a, b, c, d = state
        for i in range(64):
            turn = i // 16
            if turn == 0:
                xor(c, d, spare)
                np.bitwise_and(spare, b, spare)
                xor(spare, d, spare)
            elif turn == 1:
                xor(b, c, spare)
                np.bitwise_and(spare, d, spare)
                xor(spare, c, spare)
            elif turn == 2:
                xor(b, c, spare)
                xor(spare, d, spare)
            else:
                np.invert(d, spare)
                either(spare, b, spare)
                xor(spare, c, spare)
            add(spare, a, spare)
            first, stride = _WORDS[turn]
            word = words[piece + (first + stride * i) % 16]
            if word is None or word.ndim:
                add(spare, _SINES[i], spare)
                if word is not None:
                    add(spare, word, spare)
            else:  # one sum for all texts
                add(spare, word + _SINES[i], spare)
            np.left_shift(spare, _LEFT[turn][i % 4], part)
            np.right_shift(spare, _RIGHT[turn][i % 4], spare)
            either(spare, part, spare)
            add(spare, b, spare)
            a, b, c, d, spare = d, spare, b, c, a
        state = [a, b, c, d]
        for x, y in zip(state, before):
            add(x, np.asarray(y, np.uint32), x)
    # Digits show the lowest byte of a word first.
    return [x.byteswap(inplace=True) for x in state]


def _padded(texts: list[bytes], at: int, pieces: int) -> np.ndarray:
    """Words of the texts that begin at place ``at`` of their padded pieces, a row each."""
    sizes = np.array([len(x) for x in texts], np.int64)
    found = np.zeros((len(texts), pieces * 64), np.uint8)
    ends = np.cumsum(sizes)
    rows = np.repeat(np.arange(len(texts)), sizes)
    found[rows, at + np.arange(sizes.sum()) - np.repeat(ends - sizes, sizes)] = np.frombuffer(
        b"".join(texts), np.uint8
    )
    found[np.arange(len(texts)), at + sizes] = 0x80
    found[:, -8:] = ((at + sizes) * 8).astype("<u8")[:, None].view(np.uint8)
    return found.view("<u4")


def drawn(
    tails: list[bytes], home_below: np.ndarray, tie_below: np.ndarray, n: int, seed: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(fixtures, blocks, sides) until every fixture has had every block of scenarios.

    ``fixtures`` are places in ``tails``, in ascending order.  ``sides`` has a row per block
    and in it a place per fixture: whether the home side wins in each of the four scenarios,
    then whether it loses, as bytes.  A draw is a number of eight hex digits from the hash
    of seed, a colon, block and the fixture's tail; bounds are whole numbers up to 2 ** 32.
    """
    sizes = np.array([len(x) for x in tails], np.int64)
    below = home_below, np.maximum(home_below, tie_below)
    bounds = [np.minimum(x, 2**32 - 1).astype(np.uint32) for x in below]
    always = [x >= 2**32 for x in below]
    last = (n - 1) // LANES
    low = 0
    while low <= last:
        # Numbers of equally many digits stand before the tails, so these begin at one place.
        high = min(last + 1, 10 ** len(str(low)))
        heads = [f"{seed}:{block}".encode() for block in range(low, high)]
        at = len(heads[0])
        pieces = (at + sizes + 8) // 64 + 1
        for k in np.unique(pieces):
            (own,) = np.nonzero(pieces == k)
            fronts = _heads(heads, int(k))
            for start in range(0, len(own), AT_ONCE):
                some = own[start : start + AT_ONCE]
                ends = np.ascontiguousarray(_padded([tails[i] for i in some], at, int(k)).T)
                held = [end if end.any() else None for end in ends]
                limits = [b[some] for b in bounds]
                sure = [a[some] if a[some].any() else None for a in always]
                step = max(1, AT_ONCE // len(some))
                for first in range(0, len(heads), step):
                    front = fronts[first : first + step]
                    blocks = np.arange(low + first, low + first + len(front))
                    lanes = md5_lanes(_joined(front, held), (len(front) * len(some),))
                    yield some, blocks, _sides(lanes, limits, sure)
        low = high


def _heads(heads: list[bytes], pieces: int) -> np.ndarray:
    found = np.zeros((len(heads), pieces * 64), np.uint8)
    found[:, : len(heads[0])] = np.frombuffer(b"".join(heads), np.uint8).reshape(len(heads), -1)
    return found.view("<u4")


def _joined(fronts: np.ndarray, ends: list) -> list:
    """Words of every front with every end, flat; without a dimension where the ends are zero,
    which is None, and there is one front, and None where all are zero."""
    words = []
    for front, end in zip(fronts.T, ends):
        if len(front) == 1 and end is None:
            words.append(np.array(front[0]) if front[0] else None)
        elif len(front) == 1 and not front[0]:
            words.append(end)
        elif end is None:
            words.append(np.repeat(front, _width(ends)) if front.any() else None)
        else:
            words.append((front[:, None] | end[None, :]).ravel())
    return words


def _width(ends: list) -> int:
    # No text is without its end mark, so some word of the ends is not zero.
    return len(next(end for end in ends if end is not None))


def _sides(lanes: list[np.ndarray], bounds: list[np.ndarray], always: list) -> np.ndarray:
    """Whether the home side wins and loses; ``bounds`` of neither are not below those of a
    win, and ``always`` tells which of them lie above all draws, None if none do."""
    home, tie = bounds
    draws = [x.reshape(-1, len(home)) for x in lanes]
    won, lost = [x < home for x in draws], [x >= tie for x in draws]
    if always[0] is not None:
        for side in won:
            side |= always[0]
    if always[1] is not None:
        for side in lost:
            side &= ~always[1]
    return np.stack([x.view(np.uint8) for x in won + lost], axis=-1)


def counted(
    tails: list[bytes], home_below: np.ndarray, tie_below: np.ndarray, n: int, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """In how many of the scenarios the home side of each fixture wins, and loses."""
    won, lost = np.zeros(len(tails), np.int64), np.zeros(len(tails), np.int64)
    for some, blocks, sides in drawn(tails, home_below, tie_below, n, seed):
        inside = blocks[:, None] * LANES + np.arange(LANES) < n
        if not inside.all():
            sides = sides * np.tile(inside, 2)[:, None, :].astype(np.uint8)
        # One row per block is summed as a whole; eight bytes of a fixture at a time.
        both = sides.sum(axis=0, dtype=np.int64) if len(blocks) > 1 else sides[0].astype(np.int64)
        won[some] += both[:, :LANES].sum(axis=1)
        lost[some] += both[:, LANES:].sum(axis=1)
    return won, lost


def _starts(codes: np.ndarray, most: int) -> np.ndarray:
    """Where runs of equal codes begin, none longer than ``most``."""
    cuts = np.flatnonzero(np.diff(codes, prepend=codes[0] - 1))
    sizes = np.diff(np.append(cuts, len(codes)))
    return np.concatenate([np.arange(c, c + s, most) for c, s in zip(cuts, sizes)])


def team_sums(
    tails: list[bytes],
    home: np.ndarray,
    away: np.ndarray,
    home_below: np.ndarray,
    tie_below: np.ndarray,
    n: int,
    seed: int,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(blocks, teams, points, margins) summed over some fixtures; the parts of all of them
    are to be added up.  Teams are numbers; points and goal differences have a row per block
    and in it a place per team and scenario of the block.
    """
    # Fixtures of one pair stand together, and so do the pairs of one home team.
    order = np.lexsort((away, home))
    tails = [tails[i] for i in order]
    home, away, home_below, tie_below = (x[order] for x in (home, away, home_below, tie_below))
    known = None
    for some, blocks, sides in drawn(tails, home_below, tie_below, n, seed):
        if known is None or known[0] is not some:
            # Up to 255 bytes are summed side by side, as one number of eight bytes.
            pairs = _starts(home[some] * (int(away.max()) + 1) + away[some], 255)
            sizes = np.diff(np.append(pairs, len(some)))
            host, guest = home[some][pairs], away[some][pairs]
            by_guest = np.argsort(guest, kind="stable")
            hosts, guests = _starts(host, len(host)), _starts(guest[by_guest], len(guest))
            teams = np.union1d(host, guest)
            at_host = np.searchsorted(teams, host[hosts])
            at_guest = np.searchsorted(teams, guest[by_guest][guests])
            games = np.zeros(len(teams), np.int64)
            np.add.at(games, np.searchsorted(teams, host), sizes)
            np.add.at(games, np.searchsorted(teams, guest), sizes)
            known = (some,)
        sums = np.add.reduceat(sides.view(np.uint64)[:, :, 0], pairs, axis=1)
        sums = sums[:, :, None].view(np.uint8).astype(np.int64)
        won = np.zeros((len(blocks), len(teams), LANES), np.int64)
        lost = np.zeros_like(won)
        at_home = np.add.reduceat(sums, hosts, axis=1)
        won[:, at_host] += at_home[:, :, :LANES]
        lost[:, at_host] += at_home[:, :, LANES:]
        abroad = np.add.reduceat(sums[:, by_guest], guests, axis=1)
        won[:, at_guest] += abroad[:, :, LANES:]
        lost[:, at_guest] += abroad[:, :, :LANES]
        yield blocks, teams, won * 2 + games[:, None] - lost, won - lost
