"""Domain tables derived from generic test tables, and one query per operator over them."""
