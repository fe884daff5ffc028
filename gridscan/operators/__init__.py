"""The scan rules: options, header and type inference, conversion of cells."""
