"""A small LR automaton and a weighted graph-structured stack over it, for repairing sequences of roles.

The stack's nodes are shared: a stack is its top node, and equal stacks are one node. A frontier maps
tops to the cheapest (cost, audit) that leads to them.
"""

from __future__ import annotations

from collections.abc import Iterable

Production = tuple[str, tuple[str, ...]]

#: ``(s?(ua)+)?``: an empty conversation, or turns after an optional head. The head is reduced
#: before the first turn, so stacks with and without one have equal tops from there on.
ROLE_GRAMMAR: tuple[Production, ...] = (
    ("S", ()),
    ("S", ("T",)),
    ("T", ("H", "u", "a")),
    ("T", ("T", "u", "a")),
    ("H", ()),
    ("H", ("s",)),
)
END = "$"


class Automaton:
    """SLR(1) item sets of a grammar whose first production's left side is the start symbol."""

    def __init__(self, grammar: Iterable[Production]) -> None:
        self.grammar = [("", (next(iter(grammar))[0],)), *grammar]
        self.nonterminals = {left for left, _ in self.grammar}
        self.terminals = {x for _, right in self.grammar for x in right} - self.nonterminals
        self.follow = self._follow()
        self.states = [self._closure({(0, 0)})]
        self.goto: dict[tuple[int, str], int] = {}
        for state, items in enumerate(self.states):  # grows while it is walked
            for symbol in sorted({self.grammar[p][1][d] for p, d in items if d < len(self.grammar[p][1])}):
                moved = self._closure({(p, d + 1) for p, d in items if self.grammar[p][1][d : d + 1] == (symbol,)})
                if moved not in self.states:
                    self.states.append(moved)
                self.goto[state, symbol] = self.states.index(moved)

    def _closure(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        found, open_ = set(items), list(items)
        while open_:
            p, d = open_.pop()
            for symbol in self.grammar[p][1][d : d + 1]:
                new = {(q, 0) for q, (left, _) in enumerate(self.grammar) if left == symbol} - found
                found |= new
                open_ += new
        return frozenset(found)

    def _follow(self) -> dict[str, set[str]]:
        empty: set[str] = set()
        first: dict[str, set[str]] = {n: set() for n in self.nonterminals} | {t: {t} for t in self.terminals}
        follow: dict[str, set[str]] = {n: set() for n in self.nonterminals}
        follow[""] = {END}
        size = -1
        while size != (size := len(empty) + sum(map(len, first.values())) + sum(map(len, follow.values()))):
            for left, right in self.grammar:
                if all(x in empty for x in right):
                    empty.add(left)
                for i, x in enumerate(right):
                    if all(y in empty for y in right[:i]):
                        first[left] |= first[x]
                    if x in self.nonterminals:
                        for j in range(i + 1, len(right) + 1):
                            if all(y in empty for y in right[i + 1 : j]):
                                follow[x] |= first[right[j]] if j < len(right) else follow[left]
        return follow

    def reductions(self, state: int, ahead: str) -> list[Production]:
        found = (self.grammar[p] for p, d in self.states[state] if d == len(self.grammar[p][1]))
        return [rule for rule in found if rule[0] and ahead in self.follow[rule[0]]]

    def accepts(self, state: int) -> bool:
        return (0, 1) in self.states[state]


class Node:
    """The top of a stack: an LR state over another node."""

    __slots__ = ("state", "below", "moves", "ends")

    def __init__(self, state: int, below: Node | None) -> None:
        self.state, self.below = state, below
        self.moves: dict[str, tuple[Node, ...]] = {}
        self.ends: bool | None = None


class Stacks:
    """The nodes of all stacks seen, each stack once, with what a symbol makes of it."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton
        self.nodes: dict[tuple[int, Node | None], Node] = {}
        self.start = self._node(0, None)

    def _node(self, state: int, below: Node | None) -> Node:
        return self.nodes.setdefault((state, below), Node(state, below))

    def _reduced(self, node: Node, ahead: str) -> set[Node]:
        """The stack and all that reductions before ``ahead`` make of it."""
        found, open_ = {node}, [node]
        while open_:
            top = open_.pop()
            for left, right in self.automaton.reductions(top.state, ahead):
                base = top
                for _ in right:
                    base = base.below
                new = self._node(self.automaton.goto[base.state, left], base)
                if new not in found:
                    found.add(new)
                    open_.append(new)
        return found

    def shift(self, node: Node, symbol: str) -> tuple[Node, ...]:
        """The stacks after ``symbol``. A turn that is complete is reduced at once, so equal ones meet."""
        if symbol not in node.moves:
            tops: set[Node] = set()
            for top in self._reduced(node, symbol):
                target = self.automaton.goto.get((top.state, symbol)) if symbol in self.automaton.terminals else None
                if target is not None:
                    tops.add(self._settled(self._node(target, top)))
            node.moves[symbol] = tuple(tops)
        return node.moves[symbol]

    def _settled(self, node: Node) -> Node:
        items = self.automaton.states[node.state]
        if len(items) == 1:
            ((p, d),) = items
            left, right = self.automaton.grammar[p]
            if left and d == len(right):
                base = node
                for _ in right:
                    base = base.below
                return self._settled(self._node(self.automaton.goto[base.state, left], base))
        return node

    def complete(self, node: Node) -> bool:
        if node.ends is None:
            node.ends = any(self.automaton.accepts(top.state) for top in self._reduced(node, END))
        return node.ends
