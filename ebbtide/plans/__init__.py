"""The layered run and the registered queries with their SQL oracle."""
