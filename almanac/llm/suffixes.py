"""Suffix arrays of integer strings by induced sorting, and permuted common prefixes."""

from __future__ import annotations


def suffix_array(text: list[int], letters: int) -> list[int]:
    """Order of the suffixes of `text`, whose last symbol is 0 and occurs once; symbols are below `letters`.

    Suffixes are smaller (S) or larger (L) than the next one. The substrings between leftmost S places are
    sorted by inducing, named, and if names repeat sorted by recursion; their order induces all others.
    """
    n = len(text)
    if n == 1:
        return [0]
    smaller = bytearray(n)
    smaller[n - 1] = 1
    for i in range(n - 2, -1, -1):
        a, b = text[i], text[i + 1]
        if a < b or (a == b and smaller[i + 1]):
            smaller[i] = 1
    leftmost = [i for i in range(1, n) if smaller[i] and not smaller[i - 1]]
    sizes = [0] * letters
    for symbol in text:
        sizes[symbol] += 1
    heads, tails = [0] * letters, [0] * letters
    total = 0
    for symbol, size in enumerate(sizes):
        heads[symbol] = total
        total += size
        tails[symbol] = total

    def induce(order: list[int]) -> list[int]:
        out = [-1] * n
        ends = tails[:]
        for i in reversed(order):
            symbol = text[i]
            ends[symbol] -= 1
            out[ends[symbol]] = i
        begins = heads[:]
        for i in out:
            if i > 0 and not smaller[i - 1]:
                symbol = text[i - 1]
                out[begins[symbol]] = i - 1
                begins[symbol] += 1
        ends = tails[:]
        for at in range(n - 1, -1, -1):
            i = out[at]
            if i > 0 and smaller[i - 1]:
                symbol = text[i - 1]
                ends[symbol] -= 1
                out[ends[symbol]] = i - 1
        return out

    if len(leftmost) > 1:
        following = dict(zip(leftmost, leftmost[1:] + [n - 1]))
        names = [-1] * n
        name, last = -1, None
        for i in induce(leftmost):
            if i in following:
                piece = text[i : following[i] + 1]
                if piece != last:
                    name, last = name + 1, piece
                names[i] = name
        short = [names[i] for i in leftmost]
        if name + 1 < len(leftmost):
            order = [leftmost[i] for i in suffix_array(short, name + 1)]
        else:
            order = [0] * len(leftmost)
            for i, own in zip(leftmost, short):
                order[own] = i
    else:
        order = leftmost
    return induce(order)


def common_prefixes(text: list[int], order: list[int]) -> list[int]:
    """For every place of the text: how many symbols its suffix shares with the suffix sorted before it."""
    n = len(text)
    before = [-1] * n
    for a, b in zip(order, order[1:]):
        before[b] = a
    out, same = [0] * n, 0
    for i in range(n):
        j = before[i]
        if j < 0:
            same = 0
            continue
        while i + same < n and j + same < n and text[i + same] == text[j + same]:
            same += 1
        out[i] = same
        if same:
            same -= 1
    return out
