"""Writers of files, tables and views."""
