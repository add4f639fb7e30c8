from .tables import read_table, events, EVENTS_SCHEMA, READING_SCHEMA, PAIR_SCHEMA  # noqa: F401
from .text import (  # noqa: F401
    render_reading_lines, render_pair_lines, scan_text, parse_readings,
    parse_pairs, write_lines, labelled,
)
