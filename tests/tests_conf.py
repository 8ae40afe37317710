def smoke_dir() -> str:
    return "/root/testdata/sf0.001"
