"""The cheapest edits that make a stretch of turns follow the role pattern ``(s?(ua)+)?``: bidirectional Dijkstra.

A place of the lattice is (rows used up, state of the pattern).  States: 0 nothing yet, 1 after ``s``, 2 after ``u``
(an ``a`` must follow), 3 after ``ua``.  A row is one letter of ``CODES``: its role's initial and what may become of it.

One search from the entry and one from the exits go on by turns, the one with the smaller least cost next, until no
path of the best cost can be left out; all crossings of that cost are then joined, and the least audit wins.  The
letters of an audit fix its cost, so of two audits between the same places and of one cost neither begins with the
other, and the least whole audit is made of least parts."""
from __future__ import annotations

import heapq
from functools import lru_cache

START, AFTER_S, AFTER_U, DONE = range(4)
STATES = (START, AFTER_S, AFTER_U, DONE)
ACCEPTED = (START, DONE)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# Letter of a row: s, u, a or x (any other initial); upper case if truncated; '-' if it must go.
_STEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (DONE, "u"): AFTER_U, (AFTER_U, "a"): DONE}
# The role that a new or changed row gets in each state.
ROLE = {START: "user", AFTER_S: "user", AFTER_U: "assistant", DONE: "user"}


def step(state: int, initial: str) -> int | None:
    return _STEP.get((state, initial))


def _new(state: int) -> int:
    return _STEP[state, ROLE[state][0]]


def _row_moves(code: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may become of a row."""
    moves = [("D", DELETE, state)]
    if code != "-":
        more = TRUNCATED if code.isupper() else 0
        kept = step(state, code.lower())
        if kept is not None:
            moves.append(("K", KEEP + more, kept))
        moves.append(("R", REROLE + more, _new(state)))
    return moves


_MOVES = {(c, q): _row_moves(c, q) for c in "suaxSUAX-" for q in STATES}
_BACK = {(c, to): [(letter, cost, q) for q in STATES for letter, cost, end in _MOVES[c, q] if end == to]
         for c in "suaxSUAX-" for to in STATES}
_INSERT_BACK = {to: [q for q in STATES if _new(q) == to] for to in STATES}


class _Side:
    """One of the two searches: settled places with their cost and least audit."""

    def __init__(self, sources: list[tuple[int, int]], rows: int, forward: bool) -> None:
        self.rows, self.forward = rows, forward
        self.cost = {p: 0 for p in sources}
        self.audit: dict[tuple[int, int], str] = {}
        # Free moves lead to places with fewer rows to go, so by this order they are settled before.
        self.heap = [(0, self._rank(p), p) for p in sources]
        heapq.heapify(self.heap)
        self.sources = set(sources)

    def _rank(self, place: tuple[int, int]) -> int:
        return place[0] if self.forward else self.rows - place[0]

    def least(self) -> float:
        while self.heap and self.heap[0][2] in self.audit:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self, codes: str) -> tuple[int, int]:
        cost, _, place = heapq.heappop(self.heap)
        back, ahead = (_before, _after) if self.forward else (_after, _before)
        found = [""] if place in self.sources else []
        for letter, w, other in back(codes, place):
            if other in self.audit and self.cost[other] + w == cost:
                found.append(self.audit[other] + letter if self.forward else letter + self.audit[other])
        self.audit[place] = min(found)
        for _, w, other in ahead(codes, place):
            if other not in self.audit and cost + w < self.cost.get(other, float("inf")):
                self.cost[other] = cost + w
                heapq.heappush(self.heap, (cost + w, self._rank(other), other))
        return place


def _after(codes: str, place: tuple[int, int]) -> list[tuple[str, int, tuple[int, int]]]:
    i, q = place
    out = [("I", INSERT, (i, _new(q)))]
    if i < len(codes):
        out += [(letter, w, (i + 1, to)) for letter, w, to in _MOVES[codes[i], q]]
    return out


def _before(codes: str, place: tuple[int, int]) -> list[tuple[str, int, tuple[int, int]]]:
    i, q = place
    out = [("I", INSERT, (i, p)) for p in _INSERT_BACK[q]]
    if i:
        out += [(letter, w, (i - 1, p)) for letter, w, p in _BACK[codes[i - 1], q]]
    return out


@lru_cache(maxsize=20_000)
def cheapest(codes: str, entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and least audit of the way from state ``entry`` before the rows to one of ``exits`` behind them."""
    rows = len(codes)
    ahead = _Side([(0, entry)], rows, True)
    behind = _Side([(rows, q) for q in exits], rows, False)
    best = float("inf")
    while True:
        f, b = ahead.least(), behind.least()
        # A path not crossed yet costs at least f + b; those that cost as much as the best must be finished.
        if f + b > best or f + b == float("inf"):
            break
        side, other = (ahead, behind) if f <= b else (behind, ahead)
        place = side.settle(codes)
        if place in other.audit:
            best = min(best, side.cost[place] + other.cost[place])
        for _, w, beyond in (_after if side is ahead else _before)(codes, place):
            if beyond in other.audit:
                best = min(best, side.cost[place] + w + other.cost[beyond])
    if best == float("inf"):
        return None
    found = []
    for place, audit in ahead.audit.items():
        cost = ahead.cost[place]
        if place in behind.audit and cost + behind.cost[place] == best:
            found.append(audit + behind.audit[place])
        found += [audit + letter + behind.audit[to] for letter, w, to in _after(codes, place)
                  if to in behind.audit and cost + w + behind.cost[to] == best]
    return int(best), min(found)
