"""DataFrame operators; every module is a set of functions from tables to tables."""
