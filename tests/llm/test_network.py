"""Gradients of the numpy networks against differences, and decoding against all paths."""

from itertools import product

import numpy as np

from strataflow.llm.lstm import backward, crf_decode, crf_gradient, forward, new_bilstm


def setup():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in new_bilstm(rng, 3, 4, 3).items()}
    mask = np.ones((5, 2))
    mask[3:, 1] = 0
    return rng, p, rng.normal(size=(5, 2, 3)), mask, rng.integers(0, 3, (5, 2)), rng.normal(size=(3, 3))


def test_gradients():
    _, p, x, mask, tags, moves = setup()

    def loss():
        return crf_gradient(forward(p, x, mask)[0], tags, moves, mask)[0]

    scores, memory = forward(p, x, mask, keep=True)
    _, d_scores, d_moves = crf_gradient(scores, tags, moves, mask)
    grads, d_x = backward(p, memory, d_scores)
    for array, grad in [*((p[k], grads[k]) for k in p), (moves, d_moves), (x, d_x)]:
        for i in list(np.ndindex(array.shape))[::7]:
            was = array[i]
            array[i] = was + 1e-4
            up = loss()
            array[i] = was - 1e-4
            down = loss()
            array[i] = was
            assert abs((up - down) / 2e-4 - grad[i]) < 2e-3


def test_decoding_takes_the_best_path():
    rng, _, _, mask, _, moves = setup()
    scores = rng.normal(size=(5, 2, 3))
    got = crf_decode(scores, moves, mask)
    for b, n in ((0, 5), (1, 3)):
        value = lambda path, b=b: sum(scores[t, b, k] for t, k in enumerate(path)) + sum(moves[a, c] for a, c in zip(path, path[1:], strict=False))
        assert tuple(got[:n, b]) == max(product(range(3), repeat=n), key=value)


def test_masked_steps_change_nothing():
    _, p, x, mask, _, _ = setup()
    alone = forward(p, x[:3, 1:], mask[:3, 1:])[0]
    assert np.allclose(forward(p, x, mask)[0][:3, 1:], alone, atol=1e-6)
