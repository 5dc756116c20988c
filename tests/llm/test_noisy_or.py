"""The noisy-or against a plain product over sentences, and its training against finite differences."""

import math

import numpy as np

from fleetspark.llm import toxicity


def chance(model, text):
    """1 - prod(1 - p) over sentences, then the shift of its log odds, by plain loops."""
    clean = 1.0
    for sentence in toxicity.sentences(text or ""):
        odds = model.bias
        for word in sentence:
            odds += sum(model.table.get(f, 0.0) for f in toxicity.features(word))
        clean *= 1 - 1 / (1 + math.exp(-odds))
    if clean == 1:
        return 0.0
    log_odds = math.log((1 - clean) / clean) + model.shift
    return 1 / (1 + math.exp(-log_odds))


def test_score_is_a_plain_product():
    words = ["awful", "kind", "garden", "stupid", "the", "of"]
    numbers = sorted({f for w in words for f in toxicity.features(w)})
    rng = np.random.default_rng(3)
    model = toxicity.Model(np.array(numbers), rng.normal(0, 2, len(numbers)), -2.0, 0.7)
    for _ in range(200):
        text = "".join(str(rng.choice(words)) + str(rng.choice([" ", " ", ". ", "! ", "\n"])) for _ in range(rng.integers(0, 25)))
        assert abs(model.score(text) - chance(model, text)) < 1e-9
    assert model.score(None) == model.score("") == model.score(" . ! ") == 0.0


def test_training_ends_where_the_loss_is_flat(monkeypatch):
    """By finite differences of the plain loss: after many rounds no weight's slope is far from zero, and each is near that of a plain loop."""
    rng = np.random.default_rng(4)
    ends, numbers, toxic = [], [], []
    for d in range(80):
        y, own, found = d % 2, [], []
        for _ in range(rng.integers(1, 4)):
            found += [int(k) for k in rng.integers(0, 6, rng.integers(1, 5))]
            own.append(len(found))
        if y:
            found[0] = 7
        ends.append(np.array(own))
        numbers.append(np.array(found))
        toxic.append(y if rng.random() < 0.9 else 1 - y)
    toxic = np.array(toxic)
    monkeypatch.setattr(toxicity, "ROUNDS", 4000)
    monkeypatch.setattr(toxicity, "RATE", 0.02)
    monkeypatch.setattr(toxicity, "DECAY", 1e-2)
    kept, weights, bias = toxicity.train(toxic, ends, numbers)

    def loss(w, b):
        total, table = 0.0, dict(zip(kept.tolist(), w))
        for own, found, y in zip(ends, numbers, toxic):
            clean, low = 1.0, 0
            for high in own:
                odds = b + sum(table.get(int(f), 0.0) for f in found[low:high])
                clean *= 1 - 1 / (1 + math.exp(-odds))
                low = high
            total -= math.log(1 - clean) if y else math.log(clean)
        return total / len(toxic) + toxicity.DECAY / 2 * float(np.dot(w, w))

    for i in range(len(weights)):
        step = np.zeros(len(weights))
        step[i] = 1e-5
        assert abs(loss(weights + step, bias) - loss(weights - step, bias)) / 2e-5 < 2e-3
    assert abs(loss(weights, bias + 1e-5) - loss(weights, bias - 1e-5)) / 2e-5 < 2e-3
