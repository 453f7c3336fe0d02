"""Rule patterns as one deterministic automaton over bytes, in arrays.

Patterns are a small part of regular expressions: characters, escapes, classes, groups, ``|``,
``?``, ``*``, ``+`` and ``{m,n}``. Each becomes a nondeterministic automaton (:class:`_Builder`); subset
construction joins all of them (:func:`determinized`), and states that no continuation tells apart are
merged by refining partitions (:func:`minimised`). Bytes that no pattern distinguishes are
one column of the transition array.

:func:`compile_rules` makes two automata of a set of rules. ``starts`` reads a text backwards and knows
at every byte which rules have a match beginning there. ``forward`` has a first state for each
rule and walks along one match to its end. A rule must have the form of a fixed part and a tail: once a
match is complete, every further byte either extends it or ends it for good. So the longest match is
found without going back, and the bytes after the match is complete are its value.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

OTHER = 256  # stands between texts; no pattern has it
_SPECIAL = {"n": 10, "t": 9, "r": 13, "f": 12, "v": 11}


@dataclass(frozen=True)
class Rule:
    """``least``: bytes that a value must have, from the one that completes the match on."""

    name: str
    pattern: str
    least: int = 1
    any_case: bool = False


# ---------------------------------------------------------------- patterns


class _Parser:
    """A pattern as nested tuples: ("set", bytes), ("cat", ...), ("or", ...), ("rep", x, least, most)."""

    def __init__(self, pattern: str, any_case: bool):
        self.text, self.at, self.any_case = pattern, 0, any_case

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def parse(self) -> tuple:
        found = self._either()
        if self.at < len(self.text):
            raise ValueError(f"{self.text!r}: unexpected {self._peek()!r}")
        return found

    def _either(self) -> tuple:
        ways = [self._sequence()]
        while self._peek() == "|":
            self._take()
            ways.append(self._sequence())
        return ways[0] if len(ways) == 1 else ("or", *ways)

    def _sequence(self) -> tuple:
        parts = []
        while self._peek() not in ("", "|", ")"):
            parts.append(self._repeated(self._atom()))
        return ("cat", *parts)

    def _repeated(self, atom: tuple) -> tuple:
        while (sign := self._peek()) and sign in "?*+{":
            self._take()
            least, most = {"?": (0, 1), "*": (0, None), "+": (1, None), "{": (0, 0)}[sign]
            if sign == "{":
                bounds = self.text[self.at : self.text.index("}", self.at)]
                self.at += len(bounds) + 1
                low, comma, high = bounds.partition(",")
                least, most = int(low), (int(high) if high else None) if comma else int(low)
            atom = ("rep", atom, least, most)
        return atom

    def _atom(self) -> tuple:
        sign = self._take()
        if sign == "(":
            found = self._either()
            if self._peek() != ")":
                raise ValueError(f"{self.text!r}: a group has no end")
            self._take()
            return found
        if sign == "[":
            return ("set", self._class())
        if sign in "?*+{^$.":
            raise ValueError(f"{self.text!r}: {sign!r} is not supported here")
        return ("set", self._cased({self._byte(sign)}))

    def _byte(self, sign: str) -> int:
        if sign == "\\":
            sign = self._take()
            if sign == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
            if sign.isalnum() and sign not in _SPECIAL:
                raise ValueError(f"{self.text!r}: \\{sign} is not supported")
            return _SPECIAL.get(sign, ord(sign))
        if ord(sign) > 127:
            raise ValueError(f"{self.text!r}: patterns are ASCII")
        return ord(sign)

    def _class(self) -> frozenset[int]:
        inverse = self._peek() == "^"
        self.at += inverse
        found: set[int] = set()
        while self._peek() != "]":
            low = high = self._byte(self._take())
            if self._peek() == "-" and self.text[self.at + 1 : self.at + 2] != "]":
                self._take()
                high = self._byte(self._take())
            found |= set(range(low, high + 1))
        self._take()
        found = set(self._cased(found))
        return frozenset(set(range(256)) - found if inverse else found)

    def _cased(self, found: set[int]) -> frozenset[int]:
        if self.any_case:
            found = found | {ord(chr(x).swapcase()) for x in found if x < 128 and chr(x).isalpha()}
        return frozenset(found)


def _reversed(node: tuple) -> tuple:
    kind, *rest = node
    if kind == "set":
        return node
    if kind == "rep":
        return ("rep", _reversed(rest[0]), *rest[1:])
    parts = [_reversed(x) for x in rest]
    return (kind, *(parts[::-1] if kind == "cat" else parts))


class _Builder:
    """States with moves by a set of bytes and free moves."""

    def __init__(self):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, node: tuple, start: int) -> int:
        """The state that is reached from ``start`` by what ``node`` matches."""
        kind, *rest = node
        if kind == "set":
            end = self.state()
            self.moves[start].append((rest[0], end))
            return end
        if kind == "cat":
            for part in rest:
                start = self.add(part, start)
            return start
        if kind == "or":
            end = self.state()
            for part in rest:
                self.free[self.add(part, start)].append(end)
            return end
        inner, least, most = rest
        for _ in range(least):
            start = self.add(inner, start)
        end = self.state()
        self.free[start].append(end)
        if most is None:  # once around the loop and back
            turn = self.state()
            self.free[start].append(turn)
            back = self.add(inner, turn)
            self.free[back] += [turn, end]
            return end
        for _ in range(most - least):
            start = self.add(inner, start)
            self.free[start].append(end)
        return end

    def closed(self, states) -> frozenset[int]:
        found, left = set(states), list(states)
        while left:
            for x in self.free[left.pop()]:
                if x not in found:
                    found.add(x)
                    left.append(x)
        return frozenset(found)


# ---------------------------------------------------------------- automata


@dataclass(frozen=True)
class Automaton:
    """``moves[state, column]``, the column of each byte (and of :data:`OTHER`), the rules that each state accepts as
    bits, and the first states."""

    columns: np.ndarray
    moves: np.ndarray
    accepts: np.ndarray
    firsts: tuple[int, ...]


def _columns(builder: _Builder) -> np.ndarray:
    """Bytes that are in the same sets of the patterns share a column; the last is :data:`OTHER`'s."""
    sets = {x for moves in builder.moves for x, _ in moves}
    kinds: dict[tuple, int] = {}
    kind = [kinds.setdefault(tuple(byte in x for x in sets), len(kinds)) for byte in range(256)]
    return np.array([*kind, len(kinds)], np.uint8)


def determinized(builder: _Builder, firsts: list[frozenset[int]], accepting: dict[int, int], restart: frozenset[int]) -> Automaton:
    """Subset construction. ``accepting`` gives the bit of a state; the states of ``restart`` are added at
    every step, so that matches may begin anywhere."""
    columns = _columns(builder)
    width = int(columns.max()) + 1
    byte_of = {int(c): byte for byte, c in reversed(list(enumerate(columns[:256])))}
    names: dict[frozenset[int], int] = {}
    table: list[list[int]] = []
    order: list[frozenset[int]] = []

    def number(found: frozenset[int]) -> int:
        if found not in names:
            names[found] = len(order)
            order.append(found)
        return names[found]

    starts = tuple(number(builder.closed(x | restart)) for x in firsts)
    outside = number(builder.closed(restart))
    while len(table) < len(order):
        now = order[len(table)]
        moves = [move for state in now for move in builder.moves[state]]
        row = []
        for column in range(width - 1):
            byte = byte_of[column]
            row.append(number(builder.closed({end for bytes_, end in moves if byte in bytes_} | restart)))
        table.append([*row, outside])
    accepts = [sum({accepting[x] for x in found if x in accepting}) for found in order]
    return minimised(Automaton(columns, np.array(table, np.int32), np.array(accepts, np.int64), starts))


def minimised(found: Automaton) -> Automaton:
    """States are together while they accept the same and move to states that are together."""
    _, group = np.unique(found.accepts, return_inverse=True)
    while True:
        seen = np.column_stack([group, group[found.moves]])
        _, finer = np.unique(seen, axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == group.max():
            break
        group = finer
    first = np.unique(group, return_index=True)[1]
    moves = group[found.moves[first]].astype(np.int32)
    return Automaton(found.columns, moves, found.accepts[first], tuple(int(group[x]) for x in found.firsts))


def _patterns(rules: list[Rule]) -> list[tuple]:
    return [_Parser(rule.pattern, rule.any_case).parse() for rule in rules]


def starts_automaton(rules: list[Rule]) -> Automaton:
    """Reads backwards; bit ``i`` of a state: a match of rule ``i`` begins at the byte just read."""
    builder, accepting = _Builder(), {}
    start = builder.state()
    for i, pattern in enumerate(_patterns(rules)):
        accepting[builder.add(_reversed(pattern), start)] = 1 << i
    return determinized(builder, [frozenset([start])], accepting, frozenset([start]))


def forward_automaton(rules: list[Rule]) -> Automaton:
    """Reads one match of rule ``i`` from its first state ``i``; state 0 after minimising may be any,
    so the one that leads nowhere is told by :func:`dead_state`."""
    builder, accepting, firsts = _Builder(), {}, []
    for i, pattern in enumerate(_patterns(rules)):
        start = builder.state()
        accepting[builder.add(pattern, start)] = 1 << i
        firsts.append(frozenset([start]))
    return determinized(builder, firsts, accepting, frozenset())


def dead_state(found: Automaton) -> int:
    """The state from which nothing is accepted any more: where :data:`OTHER` leads."""
    return int(found.moves[0, found.columns[OTHER]])


@dataclass(frozen=True)
class Compiled:
    """The rules with both automata, as plain arrays that are sent to the tasks."""

    rules: tuple[Rule, ...]
    starts: Automaton
    forward: Automaton


def compile_rules(rules: list[Rule]) -> Compiled:
    """Raises ``ValueError`` where a pattern is not supported, matches nothing, or is not a fixed part and a tail."""
    if len(rules) > 62:
        raise ValueError("at most 62 rules fit the bits of a state")
    forward = forward_automaton(rules)
    dead = dead_state(forward)
    for i, rule in enumerate(rules):
        if forward.accepts[forward.firsts[i]]:
            raise ValueError(f"{rule.name}: the pattern matches an empty text")
    complete = np.flatnonzero(forward.accepts)
    after = forward.moves[complete]
    if not ((after == dead) | (forward.accepts[after] == forward.accepts[complete][:, None])).all():
        raise ValueError("a complete match must be extended or ended by every byte")
    return Compiled(tuple(rules), starts_automaton(rules), forward)


# ---------------------------------------------------------------- scanning

LANES = 4096
LEAST_STEPS = 64
SCAN_BYTES = 2 << 20  # read at a time, so that memory does not grow with a text


def _states(codes: np.ndarray, found: Automaton, last: int) -> np.ndarray:
    """The state after reading each place backwards (times the columns), beginning in ``last``.

    Codes are cut into lanes that are read side by side, each from its own end. A lane begins in
    the state in which the lane behind it ended; that is guessed (nothing read yet) and the lane is read
    again where the guess was wrong, up to where it goes on as before, until all guesses are right.
    """
    steps = max(LEAST_STEPS, -(-len(codes) // LANES))
    lanes = -(-len(codes) // steps)
    width = found.moves.shape[1]
    padded = np.full(lanes * steps, found.columns[OTHER], np.uint8)
    padded[len(padded) - len(codes) :] = codes
    grid = np.ascontiguousarray(padded.reshape(lanes, steps).T)
    flat = (found.moves * width).ravel().astype(np.int32)
    states = np.empty((steps, lanes), np.int32)
    begin = np.full(lanes, found.firsts[0] * width, np.int32)
    begin[-1] = last
    state = begin
    for step in range(steps - 1, -1, -1):
        state = flat[state + grid[step]]
        states[step] = state
    while True:
        right = np.append(states[0, 1:], np.int32(last))
        todo = np.flatnonzero(right != begin)
        if not len(todo):
            return states.T.ravel()[len(padded) - len(codes) :]
        state, begin = right[todo], right
        for step in range(steps - 1, -1, -1):
            state = flat[state + grid[step, todo]]
            if (states[step, todo] == state).all():
                break
            states[step, todo] = state


def match_starts(codes: np.ndarray, found: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """Places where a match begins, and the bits of the rules that have one there: one pass over the
    columns ``codes`` of the bytes, from the last to the first."""
    width = found.moves.shape[1]
    accepts = np.repeat(found.accepts, width)
    last = found.firsts[0] * width
    places, bits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low in reversed(range(0, len(codes), SCAN_BYTES)):
        states = _states(codes[low : low + SCAN_BYTES], found, last)
        last = states[0]
        here = np.flatnonzero((accepts > 0)[states])
        places.append(here + low)
        bits.append(accepts[states[here]])
    return np.concatenate(places[::-1]), np.concatenate(bits[::-1])


def matches(data: np.ndarray, offsets: np.ndarray, compiled: Compiled) -> list[tuple[int, int, int]]:
    """(rule, first byte, end) of the leftmost longest matches of each rule that do not overlap, in the texts
    ``data[offsets[i]:offsets[i + 1]]``. Matches whose value is too short take up their bytes but are not listed."""
    starts, forward = compiled.starts, compiled.forward
    # one place between texts ends every match
    codes = np.full(len(data) + max(0, len(offsets) - 1), starts.columns[OTHER], np.uint8)
    inside = np.ones(len(codes), bool)
    inside[offsets[1:] + np.arange(len(offsets) - 1)] = False
    codes[inside] = starts.columns[data]
    places, bits = match_starts(codes, starts)
    if not len(places):
        return []
    text = np.searchsorted(offsets[1:] + np.arange(len(offsets) - 1), places)
    places, ends = places - text, offsets[1:][text]
    raw = data.tobytes()
    table = forward.moves[:, forward.columns[:256]].tolist()
    accepts = (forward.accepts > 0).tolist()
    dead = dead_state(forward)
    out = []
    for i, rule in enumerate(compiled.rules):
        mine = np.flatnonzero(bits >> i & 1)
        begins, stops = places[mine], ends[mine]
        at = 0
        while at < len(begins):
            begin, stop = int(begins[at]), int(stops[at])
            state, here, value = forward.firsts[i], begin, 0
            while here < stop:
                state = table[state][raw[here]]
                if state == dead:
                    break
                here += 1
                value += accepts[state]
            if value >= rule.least:
                out.append((i, begin, here))
            at = at + 1 if at + 1 < len(begins) and begins[at + 1] >= here else int(np.searchsorted(begins, here))
    return out
