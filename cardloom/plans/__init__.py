"""The daily runs: operators wired from input tables to output tables."""
