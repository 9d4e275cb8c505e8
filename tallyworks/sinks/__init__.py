"""Writers: text files, message records and the additive word table."""
