"""Where looks, catalogues and class tables come from."""
