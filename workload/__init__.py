"""Binding of the library to the given test tables: adapters, registered queries, and their check SQL."""
