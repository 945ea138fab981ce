"""Clauses of the toxicity grammar: against a search of every mark from the start of the text, and in time that grows with the text."""

import math
import random
import time

from loreweave.llm import toxicity

MARKS = ".!?;:,\n"


def brute_features(g, text):
    low = text.lower().replace("’", "'")
    scores, seen = [], set()
    for m in g.find.finditer(low):
        begin = max([i for i in range(m.start()) if low[i] in MARKS], default=-1) + 1
        close = min([i for i in range(m.end(), len(low)) if low[i] in MARKS], default=len(low))
        if begin not in seen:
            seen.add(begin)
            scores.append(g.clause(low[begin:close]))
    scores = [s for s in scores if s > 0]
    return [min(4.0, max(scores, default=0.0)), math.log1p(sum(scores)), math.log1p(len(scores))]


def test_clauses_equal_a_plain_search():
    rng = random.Random(5)
    g = toxicity.Grammar(toxicity.seed_lexicon(), {"vequ": 1.0})
    words = sorted(toxicity.THREATS)[:3] + sorted(toxicity.INSULTS)[:4] + sorted(toxicity.TARGETS)[:3] + ["vequin", "not", "said", "house", "a"]
    for _ in range(400):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", ". ", "!?", ",", "\n", "", "’s "]) for _ in range(rng.randint(0, 40)))
        assert g.features(text) == brute_features(g, text)


def test_time_grows_with_the_text():
    g = toxicity.Grammar(toxicity.seed_lexicon(), {})
    clause = f"you {sorted(toxicity.INSULTS)[0]}. "

    def seconds(n):
        started = time.process_time()
        found = g.features(clause * n)
        assert found[2] == math.log1p(n)
        return time.process_time() - started

    seconds(1000)
    small, large = seconds(20_000), seconds(160_000)
    assert large < 24 * small  # eight times the text; searched from the start of the text, time grows with its square
    assert large < 10
