"""Substring dedup by sliding sentence spans.

From every sentence on, the shortest run of at least ``span`` consecutive sentences
and ``min_words`` words is hashed.  Hashes are joined over the whole table; every sentence covered by a
span that is not the first of its content is removed.  A sentence ends with
its line, or with white space after a full stop, question or exclamation mark.
Where a text's last sentence goes, white space at the end of the rest goes too.

Cases: a null or empty text stays as it is; a null id counts as the largest;
rows of the same id don't remove each other's spans, and rows equal in id and
text are cut alike; the first of equal spans in order of id, then place, stays; a
text of fewer sentences than a span has none and stays as it is; a very long text is
handled whole; only the named columns are read, and others may have any name;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from . import _units

SPAN = 2
MIN_WORDS = 20


def spans(units: _units.Units, span: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    total = np.concatenate(([0], np.cumsum(units.words)))
    start = np.arange(len(units.start))
    end = np.maximum(start + span, np.searchsorted(total, total[:-1] + min_words))
    fits = end <= units.bounds[units.row + 1]
    return start[fits], end[fits]


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """ord, key, and the sentences ``start`` to ``end`` (after the last) of every span that is not the first of its content."""
    return _units.repeated(docs, _units.sentence_units, lambda units: spans(units, span, min_words), id_col, text_col)


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """The id, the text without non-first repeated spans, and the numbers of its ``sentences`` and of those ``removed``."""
    found = repeated_spans(docs, id_col, text_col, span, min_words)
    return _units.counted(_units.remove(docs, found, _units.sentence_units, id_col, text_col), id_col, text_col, "sentences")
