"""The jobs bound to the general test tables, each beside the SQL that must give the same rows."""
