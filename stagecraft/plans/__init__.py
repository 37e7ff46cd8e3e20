"""The staging job as a lazy plan, its registered queries and their SQL oracle."""
