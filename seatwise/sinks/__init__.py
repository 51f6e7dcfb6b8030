"""Writers: result DataFrames out to folders of files."""
