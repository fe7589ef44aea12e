"""Fitted models as plain values and SQL, apart from the session that fitted them."""
