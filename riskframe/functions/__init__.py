"""Column-expression helpers that keep pandas-style missing-value rules JVM-side."""

from riskframe.functions.exprs import *  # noqa: F401,F403
