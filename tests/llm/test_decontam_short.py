"""Short items are found with every allowed substitution, at every place, and by no more than the rule."""
import itertools
import random

from fraudlake.llm import decontam


def planted(rng, n):
    item = [f"i{n}w{k}" for k in range(n)]
    places = list(itertools.chain.from_iterable(itertools.combinations(range(n), m) for m in range(n // 5 + 1)))
    texts = []
    for out in itertools.chain.from_iterable(itertools.combinations(range(n), m) for m in range(n // 5 + 1)):
        w = list(item)
        for k in out:
            w[k] = f"sub{rng.randint(0, 9)}"
        edge = rng.choice([0, 3])
        texts.append(" ".join([f"n{rng.randint(0, 99)}" for _ in range(edge)] + w + [f"n{rng.randint(0, 99)}" for _ in range(edge)]))
    assert places
    return " ".join(item), texts


def test_every_substitution_of_short_items(spark):
    rng = random.Random(7)
    items, docs, want = [], [], set()
    for n in range(1, 13):
        item, texts = planted(rng, n)
        items.append((n, item))
        for t in texts:
            want.add((len(docs), n))
            docs.append((len(docs), t))
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want


def brute(text, item):
    """Whether some diagonal has a stretch of 13 tokens, or 80 % of the item, with four equal for each unequal."""
    best = False
    for d in range(-len(item) + 1, len(text)):
        a, b = max(0, -d), min(len(item), len(text) - d)
        equal = [item[i] == text[i + d] for i in range(a, b)]
        runs = [(y - x, sum(equal[x:y])) for x in range(len(equal)) for y in range(x + 1, len(equal) + 1) if 5 * sum(equal[x:y]) >= 4 * (y - x)]
        if runs:
            length, _ = max(runs)
            best |= length >= 13 or 5 * max(m for n, m in runs if n == length) >= 4 * len(item)
    return best


def test_random_texts_against_brute_force(spark):
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(12)]
    items = [(i, [rng.choice(vocab) for _ in range(rng.randint(1, 16))]) for i in range(20)]
    docs = []
    for i in range(60):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 12))]
        own = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = rng.choice(vocab)
        docs.append((i, w + own + w[::-1]))
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(
        spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()}
    assert got == {(i, j) for i, w in docs for j, v in items if brute(w, v)}
