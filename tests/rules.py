"""A plain-Python reading of the scoring rules, for checking the fold on small inputs."""

import math
import re

from tonegrain.lexicon import DEFAULT_LEXICON as LEX


def walk(text):
    """(raw, positive, negative, negated, word count) of one text."""
    words = [w.lower() for w in re.findall(r"\w+(?:'\w+)?", text)]
    raw, up, down, flipped = 0.0, set(), set(), set()
    pending = None          # (position, factor) of the token a modifier waits for
    skip_to = 0
    for i, word in enumerate(words):
        if i < skip_to:
            continue
        is_target = pending is not None and pending[0] == i
        factor = pending[1] if is_target else 1.0
        pending = None
        if not is_target:
            pair = " ".join(words[i:i + 2])
            if pair in LEX.two_word_diminishers:
                skip_to, pending = i + 2, (i + 2, LEX.two_word_diminishers[pair])
                continue
            if word in LEX.modifiers:
                pending = (i + 1, LEX.modifiers[word])
                continue
        weight = LEX.sentiment.get(word, 0)
        if not weight:
            continue
        points = weight * factor
        if any(w in LEX.negations for w in words[max(0, i - 3):i]):
            points = -points
            flipped.add(word)
        raw += points
        (up if points > 0 else down).add(word)
    return raw, sorted(up), sorted(down), sorted(flipped), len(words)


def score(raw, n_words):
    return 0.0 if n_words == 0 else math.tanh(raw / (math.sqrt(n_words) + 1))
