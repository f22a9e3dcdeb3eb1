"""Close names of two blocks that fit the memory of a task, without comparing them all.

The bounds are those of `operators/screening.py`: names that reach the threshold share so many
characters that they share their few rarest ones. Here the keys made of those exist only while two
blocks are joined. What meets is told by 64-bit masks first, and then by the Jaro-Winkler
similarity itself, whose matches are found for all pairs at once with a few operations on bits for
each position.
"""

from __future__ import annotations

from ledgerlens.functions.similarity import BOOST_ABOVE, PREFIX_LENGTH, PREFIX_SCALE


def close_pairs_kernel(threshold: float, split_pairs: int, tally: dict | None = None):
    """A function of two lists of distinct strings that yields arrays of places in the first and
    in the second: the pairs whose similarity is the threshold or more, each exactly once. Names
    of over 64 characters are told by the characters they share alone, so pairs of those may
    score less. `split_pairs` is what a key costs, counted in pairs that meet; `tally` counts
    both, and the pairs the masks let through.

    Shipped by value, as the kernel of the similarity is: nothing inside names this package.
    """
    prefix_length, scale, boost_above = PREFIX_LENGTH, PREFIX_SCALE, BOOST_ABOVE
    # Pairs held at once, keys of the first side made at once, keys of the second side held.
    at_once, met_at_once, keys_at_once, most_keys = 1_000_000, 1 << 17, 1 << 18, 2_000_000
    # Characters a key has at most, keys of a name, from how many as good as equally common
    # characters names draw, and what the calls for a choice cost, counted in pairs that meet.
    deepest, most_ways, drawn_from, call_pairs = 8, 1_000, 24, 300
    slack = 1e-9

    import math
    from itertools import combinations

    import numpy as np

    counted = tally if tally is not None else {}
    shares = [3 * (threshold - p * scale) / (1 - p * scale) - 1 for p in range(prefix_length + 1)]

    def mixed(values):
        """A 64-bit hash of each number (splitmix64)."""
        x = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def encoded(texts, n_left):
        """What is compared, for the names of both sides in one row of arrays."""
        lengths = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(lengths) - lengths
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        known = np.zeros(0x110000, np.int32)
        known[points] = 1
        letters = int(known.sum())
        known[known > 0] = np.arange(letters)
        chars = known[points]
        rows = np.repeat(np.arange(len(texts)), lengths)
        # Repeats of a character in a name are numbered apart: `anna` holds a1, n1, a2, n2.
        of = rows * letters + chars
        order = np.argsort(of, kind="stable")
        new = np.flatnonzero(np.diff(of[order], prepend=-1))
        del of
        repeat = np.empty(len(chars), np.int64)
        repeat[order] = np.arange(len(chars)) - np.repeat(new, np.diff(np.append(new, len(chars))))
        _, element = np.unique(chars * (int(repeat.max()) + 1) + repeat, return_inverse=True)
        del order, new, repeat
        kinds, cut = int(element.max()) + 1, int(lengths[:n_left].sum())
        held = np.bincount(element[:cut], minlength=kinds) * np.bincount(element[cut:], minlength=kinds)
        # First what one of the blocks lacks, which nobody shares, then the rarest.
        rank = np.empty(kinds, np.int64)
        rank[np.argsort(held, kind="stable")] = np.arange(kinds)
        lacking = int((held == 0).sum())
        elements = np.sort(rows * kinds + rank[element]) - rows * kinds
        shared = np.bincount(rows[elements >= lacking], minlength=len(texts))
        del element, rows
        # The most common elements have a bit of their own in a mask, the others share some.
        place = kinds - 1 - np.arange(kinds)
        own = 64 if kinds - lacking <= 64 else 56
        bits = np.uint64(1) << np.where(place < own, place, own + place % max(64 - own, 1)).astype(np.uint64)
        bits[:lacking] = 0
        masks = np.bitwise_or.reduceat(bits[elements], starts)
        heads = [np.zeros(len(texts), np.int64)]
        for p in range(prefix_length):
            # Who has no further character agrees with nobody there.
            head = np.where(np.arange(len(texts)) < n_left, -1, -2)
            some = lengths > p
            head[some] = np.unique(heads[-1][some] * letters + chars[starts[some] + p], return_inverse=True)[1]
            heads.append(head)
        narrow = np.uint8 if letters <= 256 else np.uint16 if letters <= 65536 else np.uint32
        return {
            "lengths": lengths, "shared": shared, "starts": starts, "first": starts + lengths - shared,
            "chars": chars.astype(narrow), "elements": elements.astype(np.int32), "mix": mixed(np.arange(kinds)),
            "own": np.where(place < own, bits, np.uint64(0)), "masks": masks,
            "taken": (shared - np.bitwise_count(masks)).astype(np.int32), "heads": heads,
        }

    def depth_of(need, window_left, window_right, n_left, n_right, pairs):
        """The characters of a key for which its rows and the pairs expected to meet cost least;
        with none all pairs of a common start meet."""
        best, least = 0, split_pairs * (n_left + n_right) + pairs
        for k in range(1, min(need, deepest) + 1):
            mine, theirs = math.comb(window_left + k, k), math.comb(window_right + k, k)
            if max(mine, theirs) > most_ways or theirs * n_right > most_keys:
                break
            meet = pairs * min(1.0, mine * theirs / math.comb(drawn_from, k))
            calls = theirs + mine * math.ceil(mine * n_left / keys_at_once)
            cost = split_pairs * (mine * n_left + theirs * n_right) + call_pairs * calls + meet
            if cost < least:
                best, least = k, cost
        return best

    def keys_of(block, rows, window, depth, head, with_before):
        """The hash of each choice of `depth` of the first `window` elements, a row for each
        choice and a column for each name; and the bits of the elements that come before the last
        of the choice and are not in it."""
        places = block["elements"][block["first"][rows][:, None] + np.arange(window)].T
        mix, own = block["mix"][places], block["own"][places]
        ways = list(combinations(range(window), depth))
        keys = np.empty((len(ways), len(rows)), np.uint64)
        before = np.zeros_like(keys) if with_before else None
        upto = np.bitwise_or.accumulate(own, axis=0) if with_before and window else own
        # The choices come in order: what one has in common with the one before it is kept.
        sums, helds, last = [mixed(head)], [np.zeros(len(rows), np.uint64)], ()
        for at, way in enumerate(ways):
            same = 0
            while same < len(last) and way[same] == last[same]:
                same += 1
            del sums[same + 1:], helds[same + 1:]
            for e in way[same:]:
                sums.append(sums[-1] + mix[e])
                if with_before:
                    helds.append(helds[-1] | own[e])
            keys[at] = sums[-1]
            if with_before and way:
                before[at] = upto[way[-1]] & ~helds[-1]
            last = way
        return keys, before

    def matched(a, b, l, w):
        """The matches of each pair as two matrices of marks, and their number."""
        width = 8 if w <= 8 else 16 if w <= 16 else 32 if w <= 32 else 64
        kind = {8: np.uint8, 16: np.uint16, 32: np.uint32, 64: np.uint64}[width]
        padded = np.zeros((len(b), width), b.dtype)
        padded[:, :w] = b
        free = np.full(len(b), (1 << w) - 1, kind)
        marks = np.zeros(len(b), np.uint64)
        reach = max(max(l, w) // 2 - 1, 0)
        for i in range(l):
            span = sum(1 << j for j in range(max(0, i - reach), min(w, i + reach + 1)))
            same = np.packbits((padded == a[:, i:i + 1]).ravel(), bitorder="little").view(kind)
            same &= free
            same &= kind(span)
            marks |= (same != 0).astype(np.uint64) << np.uint64(i)
            # The first that fits is taken.
            free &= ~(same & (~same + kind(1)))
        return marks, ~free & kind((1 << w) - 1)

    def marked(marks, width):
        little = marks.astype("<u8").view(np.uint8).reshape(len(marks), 8)
        return np.unpackbits(little, axis=1, count=width, bitorder="little").view(bool)

    def similar(block, i, j, l, w, common, need):
        """Which pairs reach the threshold."""
        keep = np.zeros(len(i), bool)
        step = 1 << 15
        for at in range(0, len(i), step):
            a = block["chars"][block["starts"][i[at:at + step]][:, None] + np.arange(l)]
            b = block["chars"][block["starts"][j[at:at + step]][:, None] + np.arange(w)]
            in_a, in_b = matched(a, b, l, w)
            m = np.bitwise_count(in_a)
            some = np.flatnonzero(m >= need)
            if not len(some):
                continue
            m = m[some].astype(np.int64)
            taken_a, taken_b = marked(in_a[some], l), marked(in_b[some], w)
            differ = a[some][taken_a] != b[some][taken_b]
            swaps = np.add.reduceat(differ, np.cumsum(m) - m, dtype=np.int64) // 2
            jaro = (m / l + m / w + (m - swaps) / m) / 3
            score = np.where(jaro > boost_above, jaro + common * scale * (1 - jaro), jaro)
            keep[at + some[score >= threshold - slack]] = True
        return keep

    def cell(block, cls, l, w, mine, theirs, need, pairs):
        """The close pairs of one class and two lengths, by their rows."""
        masks, taken, heads = block["masks"], block["taken"], block["heads"]
        some_taken = bool(taken[mine].any() and taken[theirs].any())

        def told(i, j):
            """Of the pairs whose masks share enough those that are close."""
            fit = heads[cls][i] == heads[cls][j]
            if cls < prefix_length:
                # Pairs that agree on more of their start belong to another class.
                fit &= heads[cls + 1][i] != heads[cls + 1][j]
            if some_taken:
                fit &= np.bitwise_count(masks[i] & masks[j]) + np.minimum(taken[i], taken[j]) >= need
            i, j = i[fit], j[fit]
            counted["passed"] = counted.get("passed", 0) + len(i)
            if l <= 64 and w <= 64:
                fit = similar(block, i, j, l, w, cls, need)
                i, j = i[fit], j[fit]
            return i, j

        def least(rows):
            """What the masks of a name must share at least, whoever it meets."""
            return need - taken[rows] if some_taken else np.full(len(rows), need, np.int32)

        window_left, window_right = int(block["shared"][mine[0]]) - need, int(block["shared"][theirs[0]]) - need
        depth = depth_of(need, window_left, window_right, len(mine), len(theirs), pairs)
        keys, before = keys_of(block, theirs, window_right + depth, depth, heads[cls][theirs], depth > 0)
        size = min(24, max(4, keys.size.bit_length()))
        shift, odd = np.uint64(64 - size), np.uint64(0x9E3779B97F4A7C15)
        keys *= odd
        keys >>= shift
        keys = keys.ravel()
        starts = np.zeros((1 << size) + 1, np.int32)
        np.cumsum(np.bincount(keys.view(np.int64), minlength=1 << size), out=starts[1:])
        filled = starts[1:] > starts[:-1]
        # Sorted by bucket, with the place of each in the lower half.
        keys <<= np.uint64(32)
        keys |= np.arange(keys.size, dtype=np.uint64)
        keys.sort()
        order = (keys & np.uint64(0xFFFFFFFF)).view(np.int64)
        del keys
        listed = theirs[order % len(theirs)]
        listed_masks = masks[listed]
        if depth:
            before = before.ravel()[order]
        del order
        ways = math.comb(window_left + depth, depth)
        step = max(1, keys_at_once // ways)
        for at in range(0, len(mine), step):
            rows = mine[at:at + step]
            keys, _ = keys_of(block, rows, window_left + depth, depth, heads[cls][rows], False)
            counted["keys"] = counted.get("keys", 0) + keys.size
            bucket = (keys * odd >> shift).ravel().view(np.int64)
            some = np.flatnonzero(filled[bucket])
            bucket, name = bucket[some], some % len(rows)
            first = starts[bucket].astype(np.int64)
            times = starts[bucket + 1] - first
            each = np.bincount(name, weights=times, minlength=len(rows)).astype(np.int64)
            # Who would meet more than there are is compared with each once.
            wide = each > len(theirs)
            if wide.any():
                narrow = ~wide[name]
                first, times, name = first[narrow], times[narrow], name[narrow]
                each[wide] = 0
                names, per = rows[wide], max(1, met_at_once // len(theirs))
                theirs_masks = masks[theirs]
                for k in range(0, len(names), per):
                    part = names[k:k + per]
                    counted["met"] = counted.get("met", 0) + len(part) * len(theirs)
                    i, j = np.nonzero(np.bitwise_count(masks[part][:, None] & theirs_masks) >= least(part)[:, None])
                    yield told(part[i], theirs[j])
            turn = (np.cumsum(each) - each) // at_once
            for k in range(int(turn[-1]) + 1):
                of = np.flatnonzero(turn[name] == k) if turn[-1] else slice(None)
                key_first, key_times, key_rows = first[of], times[of], rows[name[of]]
                ends = np.cumsum(key_times)
                if not len(ends):
                    continue
                counted["met"] = counted.get("met", 0) + int(ends[-1])
                # A part of the keys at a time, whose pairs stay in the cache.
                cuts = np.append(np.searchsorted(ends, np.arange(0, ends[-1], met_at_once), side="left"), len(ends))
                found = []
                for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                    if lo == hi:
                        continue
                    count, done = key_times[lo:hi], ends[lo - 1] if lo else 0
                    upto = ends[lo:hi] - done
                    place = np.repeat(key_first[lo:hi] - (upto - count), count)
                    place += np.arange(upto[-1])
                    name_masks = masks[key_rows[lo:hi]]
                    share = np.bitwise_count(np.repeat(name_masks, count) & listed_masks[place])
                    enough = np.flatnonzero(share >= (np.repeat(least(key_rows[lo:hi]), count) if some_taken else need))
                    key, place = np.searchsorted(upto, enough, side="right"), place[enough]
                    if depth:
                        # Those that share an earlier character meet on a key with that one too.
                        once = (name_masks[key] & before[place]) == 0
                        key, place = key[once], place[once]
                    found.append(key_rows[lo:hi][key] * len(masks) + listed[place])
                found = np.concatenate(found)
                yield told(*np.divmod(np.unique(found) if depth else found, len(masks)))

    def close_pairs(left, right):
        place = np.array([k for side in (left, right) for k, t in enumerate(side) if t], np.int64)
        n_left = sum(1 for t in left if t)
        if n_left in (0, len(place)):
            return
        block = encoded([t for side in (left, right) for t in side if t], n_left)
        lengths, heads = block["lengths"], block["heads"]

        def by_length(rows):
            """The rows that agree on their length and on the characters they can share."""
            both = lengths[rows] * (int(lengths.max()) + 1) + block["shared"][rows]
            rows = rows[np.argsort(both, kind="stable")]
            values, first = np.unique(np.sort(both), return_index=True)
            return [(int(lengths[of[0]]), int(block["shared"][of[0]]), of) for of in np.split(rows, first[1:])]

        names = by_length(np.arange(n_left))
        for w, their_shared, theirs in by_length(np.arange(n_left, len(place))):
            for l, my_shared, mine in names:
                for cls, share in enumerate(shares):
                    need = max(1, math.ceil(share * l * w / (l + w) - slack))
                    if need > min(my_shared, their_shared) or cls > min(l, w):
                        continue
                    # Who finds nobody of the same start needs no keys.
                    known = int(heads[cls].max()) + 1
                    there = np.bincount(heads[cls][theirs], minlength=known)
                    those = mine[there[heads[cls][mine]] > 0]
                    if len(those):
                        here = np.bincount(heads[cls][those], minlength=known)
                        found = theirs[here[heads[cls][theirs]] > 0]
                        for i, j in cell(block, cls, l, w, those, found, need, int(there[heads[cls][those]].sum())):
                            if len(i):
                                yield place[i], place[j]

    return close_pairs
