"""Column-level functions (pure Catalyst expressions, whole-stage codegen)."""

from vigil.functions.text import (  # noqa: F401
    chunk_text, clean_text, html_unescape_basic, lower_equals, sentences,
    split_topics, strip_suffix, token_count, tokens, words,
)
from vigil.functions.timefn import (  # noqa: F401
    eastern_date, format_rec_mod_dtm, trailing_window, utc_instant, week_start,
)
