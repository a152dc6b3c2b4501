import random

import pytest

from upkeep.llm import packing


def can_give(bins, sizes, capacity):
    """Whether any underfull bin could still give a piece to another, tried one by one."""
    rest = [[sizes[i] for i in b] for b in bins if sum(sizes[i] for i in b) < capacity]
    if len(rest) < 2 or sum(map(sum, rest)) > (len(rest) - 1) * capacity:
        return False
    bag = [(sum(b), {*b, *(x + y for i, x in enumerate(b) for y in b[i + 1:])}) for b in rest]
    for j, b in enumerate(rest):
        for size in set(b):
            for k, (fill, taken) in enumerate(bag):
                if k == j:
                    continue
                free = capacity - fill
                if size <= free and fill > sum(b) - size or fill >= sum(b) and any(t < size <= t + free for t in taken):
                    return True
    return False


@pytest.mark.parametrize("low, high, n", [(150, 520, 3000), (300, 520, 3000), (40, 520, 400)])
def test_no_bin_is_left_that_could_give(low, high, n):
    r = random.Random(low)
    sizes = sorted((r.randint(low, high) for _ in range(n)), reverse=True)
    start = packing.best_fit(sizes, 1024)
    got = packing.improve(start, sizes, 1024)
    assert sorted(i for b in got for i in b) == list(range(n)) and all(0 < sum(sizes[i] for i in b) <= 1024 for b in got)
    assert len(got) <= len(start) and not can_give(got, sizes, 1024)


def unlimited(bins, sizes, capacity):
    """The search without an index: each time the emptiest bin that can give at all gives its best piece."""
    rest = [list(b) for b in bins]
    total = lambda b: sum(sizes[i] for i in b)
    while len(rest) > 1 and sum(map(total, rest)) <= (len(rest) - 1) * capacity:
        for source in sorted(rest, key=total):
            best = None
            for k in rest:
                free = capacity - total(k)
                for i in source if k is not source else ():
                    for back in ((), *((x,) for x in k), *((x, y) for a, x in enumerate(k) for y in k[a + 1:])):
                        gain = sizes[i] - sum(sizes[x] for x in back)
                        fuller = total(k) >= total(source) if back else total(k) > total(source) - sizes[i]
                        if fuller and 0 < gain <= free and (best is None or gain > best[0]):
                            best = (gain, k, i, back)
            if best:
                _, k, i, back = best
                source.remove(i)
                source.extend(back)
                k[:] = [x for x in k if x not in back] + [i]
                break
        else:
            break
        rest = [b for b in rest if b]
    return rest


def test_as_few_bins_as_an_unlimited_search():
    r = random.Random(5)
    sizes = sorted((r.randint(150, 520) for _ in range(120)), reverse=True)
    start = packing.best_fit(sizes, 1024)
    assert len(packing.improve(start, sizes, 1024)) <= len(unlimited(start, sizes, 1024)) + 1
