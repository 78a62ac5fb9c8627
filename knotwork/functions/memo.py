"""A bounded memory of a function of one word, which travels to workers empty."""

from __future__ import annotations

from collections.abc import Callable


class Memo:
    """Calls ``function`` once for each argument it remembers; forgets everything when ``most`` are held."""

    def __init__(self, function: Callable, most: int = 200_000):
        self.function, self.most, self.known = function, most, {}

    def __call__(self, word):
        try:
            return self.known[word]
        except KeyError:
            if len(self.known) >= self.most:
                self.known.clear()
            out = self.known[word] = self.function(word)
            return out

    def __reduce__(self):
        return Memo, (self.function, self.most)
