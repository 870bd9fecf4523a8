"""Column functions (STR-*, ID-1, NUM-1, JSN-1, ARR-1, PRJ-2) and the LCS helper."""

from captally.functions.text import (  # noqa: F401
    append_eos,
    first_sentence,
    image_id,
    image_of_key,
    image_path,
    plot_title,
    scale_round,
    strip_text,
    to_json_text,
    wrap_single,
)
from captally.functions.tokens import caption_tokens, space_tokens, whitespace_tokens  # noqa: F401
