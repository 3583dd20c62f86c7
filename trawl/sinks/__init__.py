"""Writers: ranked run files."""
