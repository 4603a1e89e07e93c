"""DataFrame to DataFrame transforms. Unless a docstring says otherwise they run on streams too."""
