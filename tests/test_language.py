"""Languages by tables against the plain way, and what is counted for them."""

import math
import random
import re
from collections import Counter

from quern.functions import language


def test_profiles_and_classes_are_the_plain_ones(spark):
    r = random.Random(2)
    alphabets = {"a": "abcde é", "b": "cdefg  ", "c": "xyzあいう "}
    rows = [(lang, "".join(r.choices(letters, k=r.choice([1, 2, 3, 40, 300, 6000])))) for lang, letters in alphabets.items() for _ in range(30)] + [(None, "abc abc"), ("a", None), ("b", "")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    counted = {}
    for lang, text in rows:
        low = re.sub(r"\W+", " ", (text or "")[:5000].lower())
        if lang and len(low) > 2:
            counted.setdefault(lang, Counter()).update([g for g in [*low, *(low[i : i + 2] for i in range(len(low) - 1))] if g != " "])
    known = language.profiles(docs)
    assert set(known) == set(counted)
    for lang, p in known.items():
        total = sum(counted[lang].values())
        assert p == {g: math.log(n / total) for g, n in counted[lang].items()}
    for least in (1, 64, 256):
        told = language.classifier(known, least)
        assert [told(t or "") for _, t in rows] == [language.classify(t or "", known, least) for _, t in rows]
    assert language.classifier({}, 1)("abc") == language.classify("abc", {}, 1) == ""
