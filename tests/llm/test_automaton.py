"""The automaton of small merge lists against byte-pair encoding done step by step."""

import itertools
import random

import pytest

from callflow.llm.bpe_automaton import MergeAutomaton


def step_by_step(word, ranks):
    parts = [*word[:-1], word[-1] + "$"]
    while True:
        best = min((ranks[pair] for pair in itertools.pairwise(parts) if pair in ranks), default=None)
        if best is None:
            return parts
        out, i = [], 0
        while i < len(parts):
            if i + 1 < len(parts) and ranks.get((parts[i], parts[i + 1])) == best:
                out.append(parts[i] + parts[i + 1])
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out


def random_merges(rng):
    tokens, merges = [c + end for c in "abc" for end in ("", "$")], []
    for _ in range(rng.randint(1, 25)):
        u, v = rng.choice([t for t in tokens if not t.endswith("$")]), rng.choice(tokens)
        if u + v not in tokens:
            merges.append((u, v))
            tokens.append(u + v)
    return tokens, merges


@pytest.mark.parametrize("seed", range(60))
@pytest.mark.parametrize("arcs", [20, 400_000])
def test_automaton_equals_merging(monkeypatch, seed, arcs):
    monkeypatch.setattr(MergeAutomaton, "ARCS", arcs)
    rng = random.Random(seed)
    tokens, merges = random_merges(rng)
    numbers, ranks = {t: i for i, t in enumerate(tokens)}, {m: i for i, m in enumerate(merges)}
    automaton = MergeAutomaton(merges, numbers, "$")
    words = ["".join(w) for n in range(1, 5) for w in itertools.product("abc", repeat=n)]
    words += ["".join(rng.choice("abc") for _ in range(rng.randint(5, 12))) for _ in range(60)]
    for word in words:
        ids = automaton.encode(word)
        assert automaton.decode(ids) == step_by_step(word, ranks)
        state = 0
        for token in ids:  # the path is one of the table
            state = automaton.step(state, token)
            assert state == automaton.state_of[token]
        assert sum(map(len, automaton.table)) <= arcs


def test_unknown_symbols_and_states():
    automaton = MergeAutomaton([("a", "b$")], {"a": 0, "b": 1, "a$": 2, "b$": 3, "ab$": 4}, "$")
    assert automaton.encode("ab") == [4] and automaton.encode("ax") is None and automaton.encode("") == []
    assert len(automaton.origin) == 6  # the start, four symbols, one gadget
    with pytest.raises(ValueError):
        MergeAutomaton([("a", "a"), ("a", "a")], {"a": 0, "aa": 1})
