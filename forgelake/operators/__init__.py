"""Layer builders: pure ``DataFrame -> DataFrame`` functions (staging, bronze, silver, gold, reports)."""
