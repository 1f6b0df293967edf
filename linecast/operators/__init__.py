"""DataFrame -> DataFrame operators, composable with ``DataFrame.transform``."""
