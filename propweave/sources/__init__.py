"""Sources: tables, text, XML and library exchange formats, as records or properties."""
