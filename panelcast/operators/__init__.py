"""DataFrame -> DataFrame operators, composable with ``df.transform``."""
