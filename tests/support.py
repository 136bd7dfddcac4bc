"""Paths and helpers that several test modules share."""

import contextlib
import io

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def plan_text(df, mode="formatted"):
    """The text of ``df.explain(mode)`` (public API, captured from stdout)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
