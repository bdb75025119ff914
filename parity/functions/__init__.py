"""Expression-level helpers: text of definitions, parameters, columns."""

from parity.functions.columns import (  # noqa: F401
    MATCH, NO_MATCH, ONLY_A, ONLY_B, OK, NOK, NOT_OK, SIDE_BOTH, SIDE_SRC, SIDE_DEST,
    KEY_SEP_COMPARE, KEY_SEP_GROUPED, differs, all_null, any_null, key_text,
    content_status, reference_status, cross_status,
)
from parity.functions.params import bind, report, placeholders, parse_parameter_text  # noqa: F401
from parity.functions.text import split_list, output_name, parse_join_key, unique  # noqa: F401
