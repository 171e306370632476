"""Why an export can't be read, or its records can't be synced."""

from __future__ import annotations

#: Codes, in the order in which causes are looked for.
CODES = ("formato_invalido", "arquivo_vazio", "erro_leitura", "planilha_vazia", "estrutura_incompativel")
SYNC_CODES = ("payload_invalido", "erro_sincronizacao")
UPLOAD_CODE = "upload_invalido"

#: What is said of each.
MESSAGES = {
    "upload_invalido": "Nao foi possivel receber o arquivo. Tente novamente.",
    "formato_invalido": "Formato invalido. Envie um arquivo .xls exportado pelo NEX.",
    "arquivo_vazio": "Nenhum arquivo foi enviado.",
    "erro_leitura": "Nao foi possivel ler o arquivo. Verifique se e um .xls valido exportado pelo NEX.",
    "planilha_vazia": "A planilha nao contem nenhum registro.",
    "estrutura_incompativel": "A estrutura da planilha nao e compativel com a exportacao esperada do NEX.",
    "erro_sincronizacao": "Nao foi possivel concluir a importacao. Nenhum dado foi salvo.",
}


class ImportFailure(Exception):
    def __init__(self, codigo: str, mensagem: str | None = None):
        self.codigo, self.mensagem = codigo, MESSAGES[codigo] if mensagem is None else mensagem
        super().__init__(codigo, self.mensagem)
