"""DataFrame -> DataFrame operators (rows, relational, splits, fitting, audits, sweeps,
uncertainty, profiles)."""
