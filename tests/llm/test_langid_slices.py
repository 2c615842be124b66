"""A text's languages don't depend on the texts beside it."""
import numpy as np

from fraudlake.llm import langid


def test_a_text_is_judged_by_its_own_values():
    triples = 0
    clear = np.where(np.arange(40)[:, None] // 20 == np.arange(4), 0.0, -30.0)  # gains by two languages
    for g in np.linspace(0.5, 6, 56):
        logs = np.where(np.arange(12)[:, None] % 3 == np.arange(4), 0.0, -30.0)
        logs[:, 3] = -g  # fits each word a little; a pair of the others fits 8 of 12 words
        best, share = langid.infer(logs, np.zeros(12, int))
        beside = langid.infer(np.concatenate([logs, clear]), np.repeat([0, 1], [12, 40]))
        assert best[0] == beside[0][0] and abs(share[0] - beside[1][0]) < 1e-9
        triples += best[0] < 3
    assert 0 < triples < 56
