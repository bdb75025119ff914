SF = "/root/testdata"
