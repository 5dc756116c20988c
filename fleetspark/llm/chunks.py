"""What operators on tokenizers share: chunks that are encoded once, and gathers over ragged arrays.

A text is cut where its tokenizer cannot look across, each distinct chunk of a batch is encoded by the library, and a worker keeps
encodings up to a bound. A long text goes slab by slab, so that a worker holds the chunks of one batch or slab at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Bytes of encodings that a worker keeps for one tokenizer.
KEPT_BYTES = 128 << 20
#: Characters of texts that are cut into chunks at once.
SLAB = 1 << 20


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs of ``lengths`` from ``starts`` on, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


def before(lengths: np.ndarray) -> np.ndarray:
    """The sums before each entry, and the sum of all."""
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))


def slabs(texts: list[str], cut: Callable[[str, int], int]) -> Iterator[list[tuple[int, str]]]:
    """Groups of (place of the text, stretch of it), of about ``SLAB`` characters each; ``cut(text, at)`` is a place from ``at`` on where a text may be cut."""
    held, group = 0, []
    for place, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = cut(text, at + SLAB) if len(text) - at > SLAB else len(text)
            group.append((place, text[at:end]))
            held += end - at
            at = end
            if held >= SLAB:
                yield group
                held, group = 0, []
    if group:
        yield group
