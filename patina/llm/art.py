"""Adaptive radix trees over byte strings.

Inner nodes come in four layouts, for up to 4, 16, 48 and 256 children, and are replaced by
the next larger one when full. A node holds all bytes on the way to it that nothing
branches off (path compression), so chains of nodes with one child don't exist.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Sorted:
    """A layout with a sorted list of branch bytes beside the children: 4 or 16."""

    __slots__ = ("room", "keys", "nodes")

    def __init__(self, room: int) -> None:
        self.room, self.keys, self.nodes = room, bytearray(), []

    def find(self, byte: int) -> Node | None:
        at = self.keys.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> None:
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.nodes[at] = node
        else:
            self.keys.insert(at, byte)
            self.nodes.insert(at, node)

    def full(self) -> bool:
        return len(self.nodes) == self.room

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.keys, self.nodes, strict=True)


class Indexed:
    """A layout with a place for each byte, which points into 48 children."""

    __slots__ = ("places", "nodes")
    room = 48

    def __init__(self) -> None:
        self.places, self.nodes = bytearray(256), []

    def find(self, byte: int) -> Node | None:
        at = self.places[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node: Node) -> None:
        if at := self.places[byte]:
            self.nodes[at - 1] = node
        else:
            self.nodes.append(node)
            self.places[byte] = len(self.nodes)

    def full(self) -> bool:
        return len(self.nodes) == self.room

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.nodes[at - 1]) for b, at in enumerate(self.places) if at)


class Direct:
    """A layout with a child for each byte."""

    __slots__ = ("nodes",)
    room = 256

    def __init__(self) -> None:
        self.nodes: list[Node | None] = [None] * 256

    def find(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> None:
        self.nodes[byte] = node

    def full(self) -> bool:
        return False

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, node) for b, node in enumerate(self.nodes) if node is not None)


Layout = Sorted | Indexed | Direct


def grown(layout: Layout | None) -> Layout:
    """The next larger layout with the same children; the smallest for a node without any."""
    if layout is None:
        return Sorted(4)
    larger: Layout = {4: lambda: Sorted(16), 16: Indexed, 48: Direct}[layout.room]()
    for byte, node in layout.items():
        larger.put(byte, node)
    return larger


class Node:
    """``path`` are the bytes from the parent to here, branch byte first; ``value`` ends here."""

    __slots__ = ("path", "children", "value")

    def __init__(self, path: bytes, value: object = None) -> None:
        self.path, self.value = path, value
        self.children: Layout | None = None

    def add(self, node: Node) -> None:
        if self.children is None or self.children.full():
            self.children = grown(self.children)
        self.children.put(node.path[0], node)


def common_length(a: bytes, b: bytes) -> int:
    """Number of bytes that two strings begin with alike."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low, high = 0, most  # equal up to low, not up to high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class RadixTree:
    """Keys are byte strings of any length, prefixes of one another too; values are not None."""

    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, key: bytes, value: object) -> None:
        """Put ``value`` at ``key``, in place of an earlier one."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.find(key[at]) if node.children else None
            if child is None:
                node.add(Node(key[at:], value))
                return
            shared = common_length(child.path, key[at : at + len(child.path)])
            if shared < len(child.path):  # split the compressed path where the key leaves it
                upper = Node(child.path[:shared])
                child.path = child.path[shared:]
                node.children.put(upper.path[0], upper)
                upper.add(child)
                child = upper
            node, at = child, at + shared
        node.value = value

    def bottom_up(self) -> Iterator[tuple[Node, int]]:
        """Every node after its children, in key order, with the length of the keys at it."""
        stack = [(self.root, 0, False)]
        while stack:
            node, length, done = stack.pop()
            if done or node.children is None:
                yield node, length
                continue
            stack.append((node, length, True))
            below = [(child, length + len(child.path), False) for _, child in node.children.items()]
            stack.extend(reversed(below))
