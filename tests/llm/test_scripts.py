import random
from collections import Counter

import numpy as np
import pytest

from upkeep.llm import kneser_ney as kn
from upkeep.llm import ngrams
from upkeep.llm.common import materialize

RUSSIAN = "река камень ветер дорога бумага письмо зелёный холодный вечер город девочка работа всегда сегодня молоко".split()
CHINESE = "我们 今天 学习 中国 历史 城市 河流 天气 朋友 工作 电脑 时间 学校 老师 音乐".split()


def clean(words, gap, seed):
    r = random.Random(seed)
    return gap.join(r.choice(words) for _ in range(120))


def shuffled(text, seed):
    """The same letters in other places; spaces stay."""
    r = random.Random(seed)
    letters = [c for c in text if c != " "]
    r.shuffle(letters)
    it = iter(letters)
    return "".join(" " if c == " " else next(it) for c in text)


@pytest.mark.parametrize("words, gap", [(RUSSIAN, " "), (CHINESE, "")])
def test_shuffled_text_of_the_right_script_is_not_clean(spark, make_docs, words, gap):
    texts = {k: clean(words, gap, k) for k in range(160)}
    texts |= {1000 + k: shuffled(texts[k], k) for k in range(20)}
    docs = materialize(make_docs([(k, t, "xx") for k, t in texts.items()]))
    labels = spark.createDataFrame([(k, 1, 0) for k in range(40, 160)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in kn.classify(docs, labels).collect()}
    assert all(got[k]["kept"] for k in range(20)) and not any(got[1000 + k]["kept"] for k in range(20))
    assert min(got[1000 + k]["perplexity"] for k in range(20)) > 2 * max(got[k]["perplexity"] for k in range(20))


@pytest.mark.parametrize("order", [1, 2, 3, 4, 5, 6])
def test_distinct_grams_keep_whole_code_points(order):
    texts = ["", "река 河流 a😀\U0010ffff", "".join(map(chr, range(0x4E00, 0x4E00 + 9000))), "река"]
    want = Counter()
    for t in texts:
        line = [ngrams.EDGE] * (order - 1) + [ord(c) for c in t]
        want.update(tuple(line[i:i + order]) for i in range(len(t)))

    def symbols(head, gram):
        back = [(int(gram) >> 21 * k) & ngrams.EDGE for k in range(3)] + [(int(head) >> 21 * k) & ngrams.EDGE for k in range(3)]
        return tuple(reversed(back[:order]))

    for some in (texts, [texts[1]], [""]):
        keys, n = ngrams.distinct(some, order)
        assert len(set(zip(*keys, strict=True))) == len(n)
        if some is texts:
            assert {symbols(h, g): int(c) for h, g, c in zip(*keys, n, strict=True)} == want
        each, lengths = ngrams.grams(some, order)
        assert lengths.tolist() == [len(t) for t in some]
        assert Counter(zip(*each, strict=True)) == {(h, g): int(c) for h, g, c in zip(*keys, n, strict=True)}
        found = ngrams._Table(keys, np.arange(len(n), dtype=float))(each)
        assert all((keys[0][int(i)], keys[1][int(i)]) == (h, g) for i, h, g in zip(found, *each, strict=True))
