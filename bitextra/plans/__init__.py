"""Job specs (YAML or dicts) and the DataFrame plans they stand for."""
